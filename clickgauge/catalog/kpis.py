"""KPI aggregations and the registry-driven build."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import text as T
from ..operators import kpi as O
from ..operators.calendar import calendar_spine, join_calendar, stack_on_calendar, zero_fill
from ..plans import builder as B
from ..plans import registry as R
from ..plans.daily import calendar_start
from ..sources.scratch import materialize
from .base import on_hits, on_orders

HIT_REG = R.hit_basis_registry(
    "hit_basis", R.HIT_BASIS_EVENT_IDS, R.HIT_BASIS_RATE_IDS,
    ["site:view:0", "site:click:1", "site:error:2", "site:signup:3", "site:purchase:4"],
    R.HIT_BASIS_LANGUAGES, rule_dims=("post_pagename", "language", "ref_type", "browser", "va_closer_id"))
VISIT_REG = R.visit_basis_registry(
    "visit_basis", R.VISIT_BASIS_EVENTS, R.FUNNEL_RATIOS, ["45", "39", "unknown"],
    R.FUNNEL_EVENTS, "post_evar4",
    {"hd": "evar4_hd", "travel": "evar4_travel", "life": "evar4_life", "home": "evar4_home",
     "content:booking": "evar4_content-booking"}, owners={"269": R.Governance("active", "higher_is_good", "applications")})

CAL = "cal as (select cast(unnest(generate_series(min(hit_date), max(hit_date), interval 1 day)) as date) as date from {t})"
VK = "concat_ws('_', post_visid_high, post_visid_low, visit_num)"
VK4 = ("case when coalesce(post_visid_high, post_visid_low, visit_num, visit_start_time_gmt) is not null then "
       "coalesce(post_visid_high, '␀') || '_' || coalesce(post_visid_low, '␀') || '_' || coalesce(visit_num, '␀') || '_' || "
       "coalesce(visit_start_time_gmt, '␀') end")
VR2 = ("case when coalesce(post_visid_high, post_visid_low) is not null then "
       "coalesce(post_visid_high, '␀') || '_' || coalesce(post_visid_low, '␀') end")


@on_orders("calendar_spine", "select date from cal", "b as (select 1 from ohits)", CAL.format(t="ohits"))
def _(o):
    return calendar_spine(o, "hit_date")


@on_hits("daily_hits", "select hit_date as date, count(*) as hits from hits group by 1")
def _(h):
    return O.daily_hits(h, "hit_date")


@on_hits("daily_visits", f"select hit_date as date, count(distinct {VK}) as visits from hits group by 1")
def _(h):
    return O.daily_distinct(h, "hit_date", K.key_plain("post_visid_high", "post_visid_low", "visit_num"), "visits")


@on_hits("daily_visitors", "select hit_date as date, count(distinct mcvisid) as visitors from hits group by 1")
def _(h):
    return O.daily_distinct(h, "hit_date", F.col("mcvisid"), "visitors")


@on_hits("daily_visitors_pair", f"select hit_date as date, count(distinct {VR2}) as visitors from hits group by 1")
def _(h):
    return O.daily_distinct(h, "hit_date", K.key_null_safe("post_visid_high", "post_visid_low"), "visitors")


TOKENS = ("tokens as (select hit_id, hit_date, post_evar4, " + VK + " as vk, "
          "unnest(string_split(post_event_list, ',')) as t from hits)")


@on_hits("daily_event_count", """select hit_date as date, t as event_id, count(*) as n from tokens
    where t in ('20', '228', '10036') group by 1, 2""", TOKENS)
def _(h):
    return O.daily_event_count(h, "hit_date", "post_event_list", ["20", "228", "10036"])


@on_hits("daily_event_visits", """select hit_date as date, t as event_id, count(distinct vk) as visits from tokens
    where t in ('20', '228', '10036') group by 1, 2""", TOKENS)
def _(h):
    return O.daily_event_visits(h, "hit_date", K.key_plain("post_visid_high", "post_visid_low", "visit_num"),
                                "post_event_list", ["20", "228", "10036"])


@on_hits("daily_event_rate", """select hit_date as date, round(count(*) filter (where ',' || post_event_list || ',' like '%,228,%') / count(*), 9) as rate
    from hits group by 1""")
def _(h):
    return O.daily_event_rate(h, "hit_date", "post_event_list", "228").withColumn("rate", F.round("rate", 9))


@on_hits("daily_dim_share", """select hit_date as date, round(count(*) filter (where language = '45') / count(*), 9) as "45",
    round(count(*) filter (where language = '39') / count(*), 9) as "39" from hits group by 1""")
def _(h):
    df = O.daily_dim_share(h, "hit_date", "language", ["45", "39"])
    return df.select("date", *[F.round(f"`{v}`", 9).alias(v) for v in ("45", "39")])


@on_hits("event_dim_cube", """select hit_date as date, t as event_id,
    case when post_evar4 in ('hd', 'travel') then post_evar4 else 'other' end as bucket, count(distinct vk) as visits
    from tokens where t in ('228', '269') group by 1, 2, 3""", TOKENS)
def _(h):
    return O.event_dim_cube(h, "hit_date", K.key_plain("post_visid_high", "post_visid_low", "visit_num"),
                            "post_event_list", ["228", "269"], "post_evar4", ["hd", "travel"])


@on_hits("daily_page_views", """select hit_date as date, count(*) as all_hits,
    count(*) filter (where post_page_event = '0') as marked from hits group by 1""")
def _(h):
    return h.groupBy(F.col("hit_date").alias("date")).agg(
        F.sum(K.page_view_flag()).alias("all_hits"), F.sum(K.page_view_flag("page_marker")).alias("marked"))


@on_hits("pv_bucket_share", f"""select date, bucket, round(n / sum(n) over (partition by date), 9) as share from (
    select date, case when pvs = 0 then '0' when pvs = 1 then '1' when pvs = 2 then '2' when pvs <= 5 then '3-5' else '6+' end as bucket,
    count(*) as n from (select hit_date as date, {VK} as vk, count(*) filter (where post_page_event = '0') as pvs from hits group by 1, 2)
    group by 1, 2)""")
def _(h):
    df = O.pv_bucket_share(h, "hit_date", K.key_plain("post_visid_high", "post_visid_low", "visit_num"),
                           K.page_view_flag("page_marker"))
    return df.withColumn("share", F.round("share", 9))


@on_orders("kpi_ratio", """select hit_date as date, round(count(*) / count(distinct mcvisid), 9) as hits_per_visitor from ohits group by 1""")
def _(o):
    day = o.groupBy(F.col("hit_date").alias("date")).agg(F.count(F.lit(1)).alias("hits"))
    day = day.join(O.daily_distinct(o, "hit_date", F.col("mcvisid"), "visitors"), "date")
    return day.select("date", F.round(T.ratio0(F.col("hits"), F.col("visitors")), 9).alias("hits_per_visitor"))


@on_orders("zero_fill", """select date, count(hit_date) as hits from cal left join ohits on date = hit_date group by 1""",
           CAL.format(t="ohits"))
def _(o):
    return zero_fill(stack_on_calendar(calendar_spine(o, "hit_date"), [O.daily_hits(o, "hit_date")], ["hits"]), "hits")


@on_orders("join_calendar", """select date, h.n as hits, v.n as visitors from cal
    left join (select hit_date, count(*) as n from ohits group by 1) h on h.hit_date = date
    left join (select hit_date, count(distinct mcvisid) as n from ohits group by 1) v on v.hit_date = date""",
           CAL.format(t="ohits"))
def _(o):
    return join_calendar(calendar_spine(o, "hit_date"), O.daily_hits(o, "hit_date"),
                         O.daily_distinct(o, "hit_date", F.col("mcvisid"), "visitors"))


# ------------------------------------------------ the whole registry, written out as SQL

def hit_registry_sql(reg=HIT_REG, hits="hits", tokens="tokens", cal="cal") -> str:
    """Every hit-basis series spelled out from the tables."""
    ids, rates = reg.event_ids, [s for s in reg.series if s.kind == "rate"]
    ev = ", ".join(f"count(*) filter (where t = '{e}') as e{e}" for e in ids)
    shares = [s for s in reg.series if s.kind == "share"]
    sh = ", ".join(f"count(*) filter (where {s.dim} = '{s.segment}') as s{i}" for i, s in enumerate(shares))
    names = ["d.date as date", "coalesce(hits, 0) as hits_total", "coalesce(visits, 0) as visits_total",
             "coalesce(visitors, 0) as visitors_total"]
    names += [f"coalesce(e{e}, 0) as event_{e}_count" for e in ids]
    names += [f"coalesce(e{s.event} / hits, 0.0) as {s.metric_id}" for s in rates]
    names += [f'coalesce(s{i} / hits, 0.0) as "{s.metric_id}"' for i, s in enumerate(shares)]
    names += ["coalesce(hits, 0) as page_views_total", "coalesce(hits / visits, 0.0) as pv_per_visit"]
    conds = {"0": "pvs = 0", "1": "pvs = 1", "2": "pvs = 2", "3_5": "pvs between 3 and 5", "6plus": "pvs > 5"}
    bs = ", ".join(f"count(*) filter (where {c}) as b{k}" for k, c in conds.items())
    names += [f"coalesce(b{k} / visits, 0.0) as pv_bucket_share_{k}" for k in conds]
    return (f"select {', '.join(names)} from {cal} d "
            f"left join (select hit_date, count(*) as hits, count(distinct {VK}) as visits, count(distinct mcvisid) as visitors, {sh} from {hits} group by 1) a on a.hit_date = d.date "
            f"left join (select hit_date, {ev} from {tokens} group by 1) e on e.hit_date = d.date "
            f"left join (select hit_date, {bs} from (select hit_date, {VK} as vk, count(*) as pvs from {hits} group by 1, 2) group by 1) b on b.hit_date = d.date")


def visit_registry_sql() -> str:
    cols, cube = [], VISIT_REG.of(R.Cell)
    for e in VISIT_REG.event_ids:
        cols.append(f"count(distinct case when t = '{e}' then vk end) as e{e}")
    claimed = ", ".join(f"'{s.segment}'" for s in cube if s.event == "228" and s.segment)
    for i, s in enumerate(cube):
        cond = f"post_evar4 = '{s.segment}'" if s.segment else f"coalesce(post_evar4, '') not in ({claimed})"
        cols.append(f"count(distinct case when t = '{s.event}' and {cond} then vk end) as c{i}")
    names = ["d.date as date", "coalesce(hits, 0) as hits_total", "coalesce(visits, 0) as visits_total",
             "coalesce(visitors, 0) as visitors_total"]
    names += [f"coalesce(e{e}, 0) as {m}" for e, m in R.VISIT_BASIS_EVENTS.items()]
    names += [f"case when coalesce(e{d}, 0) > 0 then e{n} / e{d} else 0.0 end as {m}" for m, n, d in R.FUNNEL_RATIOS]
    names += [f"coalesce(l{v} / hits, 0.0) as language_share_{v}" for v in ("45", "39", "unknown")]
    names += [f'coalesce(c{i}, 0) as "{s.metric_id}"' for i, s in enumerate(cube)]
    langs = ", ".join(f"count(*) filter (where language = '{v}') as l{v}" for v in ("45", "39", "unknown"))
    return (f"select {', '.join(names)} from cal d "
            f"left join (select hit_date, count(*) as hits, count(distinct {VK4}) as visits, count(distinct {VR2}) as visitors, {langs} from hits group by 1) a on a.hit_date = d.date "
            f"left join (select hit_date, {', '.join(cols)} from vtokens group by 1) e on e.hit_date = d.date")


HITS_CAL = CAL.format(t="hits")
VTOKENS = f"vtokens as (select hit_date, post_evar4, {VK4} as vk, unnest(string_split(post_event_list, ',')) as t from hits)"


ORDER_REG = R.hit_basis_registry("orders", ["1", "2", "3", "4", "5"], ["3"], [], ["F", "O", "P"],
                                 rule_dims=("post_pagename", "language"))
# CTEs giving the long KPI table of the orders calendar (years of days) and of the event hits.
OLONG = ("otokens as (select hit_date, unnest(string_split(post_event_list, ',')) as t from ohits)",
         CAL.format(t="ohits").replace("cal as", "ocal as"),
         "olong as (select date, metric_id, value from (unpivot (select date, "
         + ", ".join(f'cast("{m}" as double) as "{m}"' for m in ORDER_REG.metric_ids)
         + " from (" + hit_registry_sql(ORDER_REG, "ohits", "otokens", "ocal")
         + ")) on columns(* exclude (date)) into name metric_id value value))")
HLONG = (TOKENS, HITS_CAL,
         "hlong as (select date, metric_id, value from (unpivot (select date, "
         + ", ".join(f'cast("{m}" as double) as "{m}"' for m in HIT_REG.metric_ids)
         + " from (" + hit_registry_sql() + ")) on columns(* exclude (date)) into name metric_id value value))")


def order_long(o):
    return B.kpi_long(B.kpi_wide(o, ORDER_REG))


def order_gold(o):
    """The KPI table as written: later operators read it instead of the hits."""
    return materialize(order_long(o), "gold")


def hit_gold(h):
    return materialize(B.kpi_long(B.kpi_wide(h, HIT_REG)), "gold")


def _rounded(wide, reg):
    return wide.select("date", *[F.round(f"`{s.metric_id}`", 9).alias(s.metric_id) if s.kind != "count"
                                 else F.col(f"`{s.metric_id}`") for s in reg.series])


def _rounded_sql(reg, inner):
    cols = [f'round("{s.metric_id}", 9) as "{s.metric_id}"' if s.kind != "count" else f'"{s.metric_id}"'
            for s in reg.series]
    return f"select date, {', '.join(cols)} from ({inner})"


def _long_sql(reg, inner):
    cols = ", ".join(f'round(cast("{m}" as double), 9) as "{m}"' for m in reg.metric_ids)
    return (f"unpivot (select date, {cols} from ({inner})) on columns(* exclude (date)) "
            "into name metric_id value value")


@on_hits("kpi_wide", _rounded_sql(HIT_REG, hit_registry_sql()), TOKENS, HITS_CAL)
def _(h):
    return _rounded(B.kpi_wide(h, HIT_REG), HIT_REG)


@on_hits("kpi_wide_visit_basis", _rounded_sql(VISIT_REG, visit_registry_sql()), VTOKENS, HITS_CAL)
def _(h):
    return _rounded(B.kpi_wide(h, VISIT_REG), VISIT_REG)


@on_hits("kpi_long", f"select date, metric_id, value from ({_long_sql(HIT_REG, hit_registry_sql())})", TOKENS, HITS_CAL)
def _(h):
    return B.kpi_long(B.kpi_wide(h, HIT_REG)).withColumn("value", F.round("value", 9))


@on_hits("kpi_incremental", f"select date, metric_id, value from ({_long_sql(HIT_REG, hit_registry_sql())})", TOKENS, HITS_CAL)
def _(h):
    """Two windows as a daily run builds them: the first without the late rows of its last days and with gaps
    at the edge, the second from before those on. Together they are the table of one go."""
    day = F.col("hit_date")
    early = h.where((day < F.lit("2024-01-14").cast("date")) & ((day < F.lit("2024-01-11").cast("date")) | (F.col("hit_id") % 3 > 0)))
    first = materialize(B.kpi_long(B.kpi_wide(early, HIT_REG)), "gold-early")
    start = calendar_start(first, "2024-01-11")
    second = B.kpi_long(B.kpi_wide(h.where(day >= F.lit("2024-01-11").cast("date")), HIT_REG, start))
    return first.where(F.col("date") < F.lit(start).cast("date")).unionByName(second).withColumn("value", F.round("value", 9))


@on_hits("kpi_pivot_back", """select d.date as date, cast(coalesce(hits, 0) as double) as hits_total,
    cast(coalesce(visitors, 0) as double) as visitors_total from cal d
    left join (select hit_date, count(*) as hits, count(distinct mcvisid) as visitors from hits group by 1) a on a.hit_date = d.date""", HITS_CAL)
def _(h):
    return B.kpi_pivot_back(B.kpi_long(B.kpi_wide(h, HIT_REG)), ["hits_total", "visitors_total"])


@on_hits("column_population_rate", """select hit_date as date, round(avg(case when trim(coalesce(post_pagename, '')) <> '' then 1.0 else 0.0 end), 9) as rate
    from hits group by 1""")
def _(h):
    return O.column_population_rate(h, "hit_date", "post_pagename").withColumn("rate", F.round("rate", 9))


@on_hits("low_dispersion_signal", f"""select date, round(s, 9) as share, round(stddev_samp(s) over (order by date rows between 6 preceding and current row), 9) as spread
    from (select date, avg(case when n = 2 then 1.0 else 0.0 end) as s from
    (select hit_date as date, {VK} as vk, count(*) as n from hits group by 1, 2) group by 1)""")
def _(h):
    df = O.low_dispersion_signal(h, "hit_date", K.key_plain("post_visid_high", "post_visid_low", "visit_num"), F.lit(1))
    return df.select("date", F.round("share", 9).alias("share"), F.round("spread", 9).alias("spread"))


KIND_SQL = ("case when contains(v.metric_id, '_share_') then 'share' when starts_with(v.metric_id, 'funnel_') then 'ratio' else 'count' end")


@on_hits("registry_frame", f"select v.metric_id, {KIND_SQL} as kind, {KIND_SQL} = 'count' as log_scale, "
         "case when contains(v.metric_id, '269') or starts_with(v.metric_id, 'funnel_app_start') then 'active' else 'candidate' end as status, total "
         f"from (select metric_id, round(sum(value), 6) as total from ({_long_sql(VISIT_REG, visit_registry_sql())}) group by 1) v", VTOKENS, HITS_CAL)
def _(h):
    """Kind and governance of each series next to its total."""
    reg = VISIT_REG.frame(h.sparkSession)
    totals = B.kpi_long(B.kpi_wide(h, VISIT_REG)).groupBy("metric_id").agg(F.round(F.sum("value"), 6).alias("total"))
    return totals.join(reg.select("metric_id", "kind", "log_scale", "status"), "metric_id")
