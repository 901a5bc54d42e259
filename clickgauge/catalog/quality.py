"""Joins, data-quality gates and verification reports."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import predicates as P
from ..functions.events import raw_tokens, bare_id, event_presence

from ..operators import dq as Q
from ..operators import joins as J
from ..sources import scratch
from ..sources.visits import HOT_ROWS, VisitTable

from .base import on_hits, on_orders
from .expressions import IDS_SQL
from .filters import ANY_SQL, EXC, EXCLUDE, HREFS, INC, INCLUDE, LOGIN, RULES, URL, url_of
from .kpis import HLONG, OLONG, VK, hit_gold, order_gold


def visit():
    return K.key_plain("post_visid_high", "post_visid_low", "visit_num")


@on_hits("qualified_visits", f"select hit_id from hits where {VK} in (select {VK} from hrefs where {ANY_SQL} and {VK} <> '')", HREFS)
def _(h):
    return J.qualified_visits(h, visit(), P.any_rule(RULES, "href")).select("hit_id")


@on_hits("visit_overlap", f"""select count(*) filter (where a) as visits_a, count(*) filter (where b) as visits_b,
    count(*) filter (where a and b) as both, count(*) filter (where a and not b) as a_only,
    count(*) filter (where b and not a) as b_only,
    round(count(*) filter (where a and b) / count(*) filter (where b), 9) as share_b_retained from
    (select {VK} as vk, bool_or({ANY_SQL}) as a, bool_or(campaign = 'abc') as b from hrefs group by 1)""", HREFS)
def _(h):
    out = J.visit_overlap(h, visit(), P.any_rule(RULES, "href"), F.col("campaign") == "abc")
    return out.withColumn("share_b_retained", F.round("share_b_retained", 9))


def visit_table(h, start=None, hot_rows=HOT_ROWS):
    """The hits by visit, with a fifth of the days written twice."""
    path = scratch.scratch_path(h.sparkSession, "visits")
    table = VisitTable(h.sparkSession, "visits_" + path.rsplit("-", 1)[-1], "hit_date")
    rows = h.select("hit_id", "href", "campaign", "post_visid_high", "post_visid_low", "visit_num", "hit_date")
    table.write(rows.where("hit_date < date '2024-01-25' or hit_id % 2 = 0"), visit(), path, buckets=8, hot_rows=hot_rows)
    table.write(rows, visit(), path, "2024-01-25", buckets=8, hot_rows=hot_rows)
    return table


@on_hits("visit_table_qualified", f"select hit_id from hits where {VK} in (select {VK} from hrefs where {ANY_SQL} and {VK} <> '')", HREFS)
def _(h):
    return visit_table(h).qualified(P.any_rule(RULES, "href")).select("hit_id")


@on_hits("visit_table_overlap", f"""select count(*) filter (where a) as visits_a, count(*) filter (where b) as visits_b, count(*) filter (where a and b) as both,
    count(*) filter (where a and not b) as a_only, count(*) filter (where b and not a) as b_only,
    round(count(*) filter (where a and b) / count(*) filter (where b), 9) as share_b_retained from
    (select {VK} as vk, bool_or({ANY_SQL}) as a, bool_or(campaign = 'abc') as b from hrefs where {VK} <> '' group by 1)""", HREFS)
def _(h):
    """With a limit so low that some visits are hot."""
    return visit_table(h, hot_rows=3).overlap(P.any_rule(RULES, "href"), F.col("campaign") == "abc").withColumn("share_b_retained", F.round("share_b_retained", 9))


@on_hits("visit_table_daily", f"select hit_date, count(distinct {VK}) as visits, count(*) as hits from hits where {VK} <> '' group by 1")
def _(h):
    return visit_table(h).daily_visits()


@on_orders("gap_days", """select date from (select cast(unnest(generate_series(min(hit_date), max(hit_date), interval 1 day)) as date) as date from ohits)
    where date not in (select hit_date from ohits)""")
def _(o):
    return J.gap_days(o, "hit_date")


ZERO = """select date, date not in (select hit_date from ohits) as is_synthetic from
    (select date from olong group by date having max(abs(value)) = 0)"""


@on_orders("zero_fill_trap", ZERO, *OLONG)
def _(o):
    return J.zero_fill_trap(order_gold(o), o, "hit_date")


@on_orders("mask_synthetic", "select date, metric_id, round(value, 9) as value from olong where date in (select hit_date from ohits)", *OLONG)
def _(o):
    return J.mask_synthetic(order_gold(o), o, "hit_date").select("date", "metric_id", F.round("value", 9).alias("value"))


@on_orders("cross_single_row", """select count(*) as hits, count(distinct mcvisid) as visitors, min(hit_date) as first_day from ohits""")
def _(o):
    return J.combine_single_rows(o.agg(F.count(F.lit(1)).alias("hits")),
                                 o.select("mcvisid").distinct().agg(F.count(F.lit(1)).alias("visitors")),
                                 o.agg(F.min("hit_date").alias("first_day")))


@on_orders("kpi_parity", """select count(*) as cells, count(*) filter (where date = date '2001-08-01') as unmatched,
    max(case when date <> date '2001-08-01' and metric_id = 'hits_total' then value * 0.5 else 0 end) as max_abs_diff from olong""", *OLONG)
def _(o):
    a = order_gold(o)
    b = a.where("date <> date '2001-08-01'").withColumn(
        "value", F.when(F.col("metric_id") == "hits_total", F.col("value") * 0.5).otherwise(F.col("value")))
    return J.kpi_parity(a, b)


@on_hits("join_inst_presence", f"""select id as event_id, count(*) as instances, count(distinct hit_id) as hits_with from
    (select hit_id, unnest({IDS_SQL.format(c='raw_event_list')}) as id from hits) group by 1""")
def _(h):
    inst = h.select(F.explode(F.transform(raw_tokens("raw_event_list"), bare_id)).alias("event_id")).groupBy("event_id").agg(
        F.count(F.lit(1)).alias("instances"))
    pres = h.select(F.explode(event_presence("raw_event_list")).alias("event_id")).groupBy("event_id").agg(
        F.count(F.lit(1)).alias("hits_with"))
    return J.inst_presence(inst, pres)


@on_hits("lookup_join", """select hit_id, language, case language when '45' then 'English' when '39' then 'French' end as label from hits""")
def _(h):
    lk = h.sparkSession.createDataFrame([("45", "English"), ("39", "French")], "code string, name string")
    return J.lookup_join(h.select("hit_id", "language"), lk, "language")


# ---------------------------------------------------------------- gates

@on_hits("dq_nonempty", "select count(*) as rows, case when count(*) = 0 then 'FAIL' else 'PASS' end as verdict from hits")
def _(h):
    return Q.dq_nonempty(h)


@on_hits("dq_nonnull_frac", """select round(count(post_event_list) / count(*), 9) as nonnull_frac,
    case when count(post_event_list) / count(*) < 0.95 then 'FAIL' else 'PASS' end as verdict from hits""")
def _(h):
    return Q.dq_nonnull_frac(h, "post_event_list", 0.95).withColumn("nonnull_frac", F.round("nonnull_frac", 9))


@on_hits("dq_key_cardinality", """select least(count(*), 2) as at_least, case when count(*) <= 1 then 'WARN' else 'PASS' end as verdict
    from (select distinct post_visid_high, post_visid_low from hits)""")
def _(h):
    return Q.dq_key_cardinality(h, "post_visid_high", "post_visid_low")


ELIG = "coalesce(try_cast(exclude_hit as int), 0) = 0 and coalesce(try_cast(hit_source as int), 0) not in (5, 7, 8, 9)"


@on_hits("dq_eligible_share", f"""select rows, eligible, round(eligible / rows, 9) as eligible_share,
    case when eligible / rows between 0.9 and 0.98 then 'PASS' else 'WARN' end as verdict
    from (select count(*) as rows, count(*) filter (where {ELIG}) as eligible from hits)""")
def _(h):
    return Q.dq_eligible_share(h, P.hit_eligible()).withColumn("eligible_share", F.round("eligible_share", 9))


@on_hits("dq_required_hosts", """select host, count(*) filter (where url like '%' || host || '%') as rows,
    case when count(*) filter (where url like '%' || host || '%') = 0 then 'FAIL' else 'PASS' end as verdict
    from urls, (select unnest(['plans.example.com', 'regimes.example.net', 'absent.example.org']) as host) group by host""", URL)
def _(h):
    return Q.dq_required_hosts(h, url_of(), ["plans.example.com", "regimes.example.net", "absent.example.org"])


@on_hits("dq_dead_series", """select metric_id, sum(value) as total, case when sum(value) > 0 then 'PASS' else 'FAIL' end as verdict
    from hlong where metric_id in ('hits_total', 'event_228_count', 'event_10001_count', 'event_20_count') group by 1
    union all select 'event_228_count', 0.0, 'FAIL'""", *HLONG)
def _(h):
    return Q.dq_dead_series(hit_gold(h), ["hits_total", "event_228_count", "event_10001_count", "event_20_count"])


# ---------------------------------------------------------------- verification reports

@on_orders("verify_volume", """select rows_total, days_present, first_day, last_day, days_in_span, days_in_span - days_present as gap_days,
    case when rows_total < 10 then 'FAIL' when first_day <> date '1995-01-01' then 'REVIEW' else 'PASS' end as verdict
    from (select count(*) as rows_total, count(distinct hit_date) as days_present, min(hit_date) as first_day, max(hit_date) as last_day,
    date_diff('day', min(hit_date), max(hit_date)) + 1 as days_in_span from ohits)""")
def _(o):
    return Q.verify_volume(o, "hit_date", 10, "1995-01-01")


@on_hits("verify_single_suite", """select count(distinct rsid) as distinct_suites, max(rsid) as suite_seen,
    count(*) filter (where rsid <> 'suite_a') as foreign_rows, case when count(distinct rsid) = 1 and max(rsid) = 'suite_a' then 'PASS' else 'FAIL' end as verdict
    from hits""")
def _(h):
    return Q.verify_single_suite(h, "rsid", "suite_a")


@on_hits("verify_scope_held", f"""select in_scope_rows, blank_rows, off_pattern_rows, noise_rows, login_rows,
    case when login_rows > 0 then 'FAIL' when noise_rows > 0 or off_pattern_rows > 0 then 'REVIEW' else 'PASS' end as verdict from
    (select count(*) filter (where {INC}) as in_scope_rows, count(*) filter (where url = '') as blank_rows,
    count(*) filter (where url <> '' and not {INC}) as off_pattern_rows, count(*) filter (where {EXC}) as noise_rows,
    count(*) filter (where url like '%login.example.com%' or url like '%id.example.com%') as login_rows from urls)""", URL)
def _(h):
    u = url_of()
    return Q.verify_scope_held(h, u, P.like_any(u, INCLUDE), P.like_any(u, EXCLUDE), P.like_any(u, LOGIN))


@on_hits("verify_domains", """select en_rows, fr_rows, retired_rows, leakage_rows,
    case when en_rows = 0 or fr_rows = 0 or leakage_rows > 0 then 'FAIL' else 'PASS' end as verdict from
    (select count(*) filter (where url like '%plans.example.com%') as en_rows, count(*) filter (where url like '%regimes.example.net%') as fr_rows,
    count(*) filter (where url like '%old.example.org%') as retired_rows, count(*) filter (where url like '%uat.%') as leakage_rows from urls)""", URL)
def _(h):
    return Q.verify_domains(h, url_of(), {"en": "%plans.example.com%", "fr": "%regimes.example.net%"},
                            {"retired": "%old.example.org%"}, ["%uat.%"])


@on_hits("verify_conform", f"""select raw_rows, conformed_rows, round(ev / conformed_rows, 9) as event_list_nonnull, round(l45 / conformed_rows, 9) as share_45,
    round(conformed_rows / raw_rows, 9) as conformed_share,
    case when ev / conformed_rows < 0.9 then 'FAIL' when not conformed_rows / raw_rows between 0.9 and 0.98 then 'REVIEW' else 'PASS' end as verdict from
    (select count(*) as raw_rows, count(*) filter (where {ELIG}) as conformed_rows, count(post_event_list) filter (where {ELIG}) as ev,
     count(*) filter (where {ELIG} and language = '45') as l45 from hits)""")
def _(h):
    out = Q.verify_conform(h, h.where(P.hit_eligible()), "post_event_list", 0.90, (0.90, 0.98), ["45"])
    return out.select("raw_rows", "conformed_rows", "verdict",
                      *[F.round(c, 9).alias(c) for c in ("event_list_nonnull", "share_45", "conformed_share")])


@on_hits("verify_pseudonym", """select count(mcvisid) as hashed_rows, 0::bigint as raw_rows, count(*) - count(mcvisid) as null_rows,
    64::bigint as max_length, 'PASS' as verdict from hits""")
def _(h):
    return Q.verify_pseudonym(h.select(K.pseudonymize("mcvisid", "secret").alias("mcvisid")), "mcvisid")


@on_hits("verify_gold_shape", """select count(distinct date) as days_present, count(distinct metric_id) as series_count, count(*) as long_rows,
    count(*) filter (where value is null) as null_values, date_diff('day', min(date), max(date)) + 1 as days_in_span, 'PASS' as verdict from hlong""", *HLONG)
def _(h):
    return Q.verify_gold_shape(hit_gold(h), 42)


@on_hits("verify_pv_identity", """select count(*) as days, count(*) filter (where abs(h - p) > 1e-9) as basis_mismatch_days,
    count(*) filter (where v > 0 and abs(b - 1.0) > 1e-6) as partition_violations, round(avg(case when v > 0 then p / v end), 9) as mean_pv_per_visit, 'PASS' as verdict
    from (select date, max(value) filter (where metric_id = 'hits_total') as h, max(value) filter (where metric_id = 'page_views_total') as p,
    max(value) filter (where metric_id = 'visits_total') as v, sum(value) filter (where metric_id like 'pv_bucket_share_%') as b from hlong group by 1)""", *HLONG)
def _(h):
    return Q.verify_pv_identity(hit_gold(h)).withColumn("mean_pv_per_visit", F.round("mean_pv_per_visit", 9))


FUNNEL = ["event_20_count", "event_228_count", "event_10001_count"]


@on_hits("verify_funnel_events", """select metric_id, sum(value) as total, count(*) filter (where value > 0) as days_firing, count(*) as days_present,
    case when sum(value) > 0 then 'PASS' else 'FAIL' end as verdict from hlong
    where metric_id in ('event_20_count', 'event_228_count', 'event_10001_count') group by 1""", *HLONG)
def _(h):
    return Q.verify_funnel_events(hit_gold(h), FUNNEL)


@on_hits("verify_funnel_ratios", """select round(a / nullif(b, 0), 9) as start_over_view, round(c / nullif(a, 0), 9) as flag_over_start,
    case when c / nullif(a, 0) is null then 'FAIL' when c / a > 1 then 'REVIEW' else 'PASS' end as verdict from
    (select sum(value) filter (where metric_id = 'event_228_count') as a, sum(value) filter (where metric_id = 'event_20_count') as b,
    sum(value) filter (where metric_id = 'event_10036_count') as c from hlong)""", *HLONG)
def _(h):
    out = Q.verify_funnel_ratios(hit_gold(h), {"start_over_view": ("event_228_count", "event_20_count"),
                                               "flag_over_start": ("event_10036_count", "event_228_count")})
    return out.select(F.round("start_over_view", 9).alias("start_over_view"), F.round("flag_over_start", 9).alias("flag_over_start"), "verdict")


@on_hits("verify_lang_share", """select metric_id, round(avg(value), 9) as mean_share, round(min(value), 9) as min_share, round(max(value), 9) as max_share,
    case when sum(value) > 0 then 'PASS' else 'FAIL' end as verdict from hlong where metric_id in ('language_share_45', 'language_share_39') group by 1""", *HLONG)
def _(h):
    out = Q.verify_lang_share(hit_gold(h), ["language_share_45", "language_share_39"])
    return out.select("metric_id", "verdict", *[F.round(c, 9).alias(c) for c in ("mean_share", "min_share", "max_share")])


@on_orders("verify_zero_fill", f"""select count(*) as zero_days, count(*) filter (where is_synthetic) as synthetic_days,
    count(*) filter (where not is_synthetic) as genuine_days, case when count(*) > 0 then 'REVIEW' else 'PASS' end as verdict from ({ZERO})""", *OLONG)
def _(o):
    return Q.verify_zero_fill(order_gold(o), o, "hit_date")
