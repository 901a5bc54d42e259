"""Profiling aggregates: volumes, columns, events, feed quality."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import predicates as P

from ..functions import url as U

from ..operators import census as C
from ..operators import eventstats as EV
from ..operators import feedquality as FQ
from ..operators import rollups as RU
from ..operators import volume as V
from ..sources import adapters as A
from ..sources import scratch
from ..sources.scratch import materialize
from .base import on_hits, on_orders
from .expressions import HOST_LANGS, HOST_LANG_SQL, IDS_SQL
from .filters import EXC, EXCLUDE, INC, INCLUDE, URL, url_of
from .kpis import VK
from .quality import ELIG, visit
from .series import rounded

N = "count(*) filter (where {})".format
PAIR = "concat_ws('_', post_visid_high, post_visid_low)"


def pair():
    return K.key_plain("post_visid_high", "post_visid_low")


def in_scope():
    return P.scope_url(url_of(), INCLUDE, EXCLUDE)


@on_hits("daily_volume", f"select hit_date as date, count(*) as total, {N(f'{INC} and not {EXC}')} as scoped, {N(chr(117) + 'rl = ' + chr(39) * 2)} as url_blank from urls group by 1", URL)
def _(h):
    return V.daily_volume(h, "hit_date", in_scope(), url_of())


@on_orders("month_window", "select cast(date_trunc('month', max(hit_date)) - interval 13 month as date) as start, max(hit_date) as last from ohits")
def _(o):
    return V.month_window(o, "hit_date", 13)


@on_orders("trailing_window", "select hit_id from ohits where hit_date >= (select max(hit_date) - 90 from ohits)")
def _(o):
    return V.trailing_window(o, "hit_date", 90).select("hit_id")


@on_hits("window_crosscheck", """select w as window_rows, s as daily_sum, w = s as equal from (select (select count(*) from hits where hit_date >= date '2024-01-11') as w,
    (select sum(n)::bigint from (select hit_date, count(*) as n from hits group by 1) where hit_date >= date '2024-01-11') as s)""")
def _(h):
    return V.window_crosscheck(h, V.daily_volume(h, "hit_date", in_scope(), url_of()), "hit_date", "2024-01-11")


FAMILY_COLS = ["post_evar4", "post_evar8", "campaign", "geo_country", "geo_region", "geo_city", "mcvisid", "post_visid_high",
               "post_visid_low", "mobileappid", "mobiledevice", "page_url", "post_page_url", "visit_start_page_url", "href",
               "date_time", "hit_time_gmt", "rsid", "browser"]
FAMILY_CTES = ("per as (" + " union all ".join(f"select '{c}' as c, count(nullif(trim(cast({c} as varchar)), '')) as p from hits" for c in FAMILY_COLS) + ")",
               "fam as (select * from (values ('custom_vars', '^(post_)?(evar|prop)[0-9]+$|^(post_)?campaign$'), ('identity', 'visid|cust_id|userid|username|cookie'), "
               "('geo', '^geo_|zip|country|region|city'), ('time', 'time|date|_gmt$|^ts$'), ('mobile', '^mobile'), ('url', 'url|referrer|href')) t(family, re))",
               "tagged as (select c, p, coalesce(family, 'other') as family from per left join fam on regexp_matches(c, re))")


@on_hits("column_families", "select family, count(*) as columns, count(*) filter (where p > 0) as populated_columns from tagged group by 1", *FAMILY_CTES)
def _(h):
    return C.column_families(C.population_census(h, FAMILY_COLS))


@on_hits("window_diagnostics", f"""select count(*) as total, {N(f'rsid = $$suite_a$$ and not {INC}')} as suite_only, {N(f'rsid <> $$suite_a$$ and {INC}')} as url_only,
    {N(f'rsid = $$suite_a$$ and {INC}')} as both, {N('url = $$$$')} as url_blank from urls""", URL)
def _(h):
    return V.window_diagnostics(h, F.col("rsid") == "suite_a", P.like_any(url_of(), INCLUDE), url_of())


@on_hits("bot_drop_diagnostics", f"""select count(*) as total, {N(INC)} as url_match, {N(f'{INC} and not {EXC}')} as in_scope,
    {N(f'{INC} and not {EXC} and not ({ELIG})')} as dropped_in_scope from urls""", URL)
def _(h):
    return V.bot_drop_diagnostics(h, P.like_any(url_of(), INCLUDE), in_scope(), P.hit_eligible())


@on_hits("host_breakdown", """select regexp_extract(url, '://([^/?#]+)', 1) as host, count(*) as rows, round(100.0 * count(*) / sum(count(*)) over (), 3) as pct_of_scope from urls group by 1
    order by rows desc, host limit 15""", URL)
def _(h):
    return V.breakdown(h, U.url_host(U.drop_scheme(url_of())), "host", 15)


@on_hits("sample_frame", f"select hit_id from hits where substr(md5('42:' || cast(hit_id as string)), 1, 8) < '{int(0.05 * 2 ** 32):08x}'")
def _(h):
    return V.sample_frame(h, 0.05, "hit_id").select("hit_id")


CENSUS = ["hit_id", "page_url", "post_page_url", "mcvisid", "post_evar4", "mobileappid", "va_closer_id"]


@on_hits("population_census", " union all ".join(
    f"select '{c}' as column_name, count(nullif(trim(cast({c} as string)), '')) as populated, round(100.0 * count(nullif(trim(cast({c} as string)), '')) / count(*), 3) as pop_pct, "
    f"count(distinct nullif(trim(cast({c} as string)), '')) as distinct_values, case when count(nullif(trim(cast({c} as string)), '')) / count(*) >= 0.99 then 'core' else 'populated' end as class from hits"
    for c in CENSUS))
def _(h):
    return C.population_census(h, CENSUS, exact=True)


SKETCH_ERROR = 0.15  # three standard errors of the sketched distinct count


def _within(approx, exact, name):
    return (F.abs(approx - exact) <= F.greatest(SKETCH_ERROR * exact, F.lit(1.0))).alias(name)


@on_hits("population_census_approx", " union all ".join(
    f"select '{c}' as column_name, count(nullif(trim(cast({c} as varchar)), '')) as populated, count(*) > 0 as within_error from hits" for c in A.HIT_COLUMNS))
def _(h):
    """Every column of the hit table with sketched distinct counts, next to the exact ones."""
    exact = C.population_census(h, exact=True).select("column_name", F.col("distinct_values").alias("exact"))
    both = C.population_census(h).join(exact, "column_name")
    return both.select("column_name", "populated", _within(F.col("distinct_values"), F.col("exact"), "within_error"))


@on_hits("batched_agg", " union all ".join(f"select '{c}' as name, cast(count({c}) as double) as value from hits" for c in CENSUS))
def _(h):
    return C.batched_agg(h, [(c, F.count(c)) for c in CENSUS], batch=3)


@on_hits("top_values", "select post_pagename as value, count(*) as n, round(100.0 * count(*) / (select count(*) from hits), 3) as pct from hits where trim(post_pagename) <> '' group by 1 order by 2 desc, 1 limit 10")
def _(h):
    return C.top_values(h, "post_pagename", 10)


SHAPE = ["page_url", "post_pagename", "brand_tag"]


def _shape_sql(c):
    v = f"nullif(trim({c}), '')"
    return (f"select '{c}' as column_name, median(length({c})) filter (where {v} is not null) as len_p50, round(avg(length({c})) filter (where {v} is not null), 9) as len_avg, "
            f"cast(max(length({c})) filter (where {v} is not null) as int) as len_max, round(avg(starts_with({c}, 'http')::int) filter (where {v} is not null), 9) as url_frac, "
            f"avg(starts_with({c}, 'http')::int) filter (where {v} is not null) > 0.5 as looks_like_url, avg(length({c})) filter (where {v} is not null) > 80 as free_text from hits")


@on_hits("text_shape", " union all ".join(map(_shape_sql, SHAPE)))
def _(h):
    return rounded(C.text_shape(h, SHAPE), "len_avg", "url_frac")


CUSTOM = ["post_evar4", "post_evar8", "campaign"]
CUSTOM_SQL = ("select column_name, distinct_values, populated, top from (" + " union all ".join(
    f"select '{c}' as column_name, count(*) as distinct_values, cast(sum(n) as bigint) as populated, array_to_string(list(v || '=' || cast(n as string) order by n desc, v)[1:5], ';') as top from (select {c} as v, count(*) as n from hits where trim({c}) <> '' group by 1)"
    for c in ("post_evar4", "post_evar8", "campaign")) + ")")


@on_hits("custom_dims", CUSTOM_SQL)
def _(h):
    out = C.custom_dims(h, CUSTOM, 5)
    top = F.array_join(F.transform("top", lambda t: F.concat(t["value"], F.lit("="), t["n"])), ";")
    return out.select("column_name", "distinct_values", "populated", top.alias("top"))


@on_hits("custom_dims_sketched", f"select column_name, distinct_values > 0 as distinct_within, populated, top from ({CUSTOM_SQL})")
def _(h):
    """Top values exactly, from a sketch's candidates; distinct counts within the sketch's error."""
    out = C.custom_dims(h, CUSTOM, 5, exact=False).join(C.custom_dims(h, CUSTOM, 5).select("column_name", F.col("distinct_values").alias("exact")), "column_name")
    top = F.array_join(F.transform("top", lambda t: F.concat(t["value"], F.lit("="), t["n"])), ";")
    return out.select("column_name", _within(F.col("distinct_values"), F.col("exact"), "distinct_within"), "populated", top.alias("top"))


@on_hits("top_values_sketched", "select page_url as value, count(*) as n, round(100.0 * count(*) / (select count(*) from hits), 3) as pct from hits where trim(page_url) <> '' group by 1 order by 2 desc, 1 limit 10")
def _(h):
    """Nearly unique urls: the sketch proves nothing here, so this is the full count."""
    return C.top_values(h, "page_url", 10, sketched=True)


@on_hits("event_freq", f"""select id as event_id, count(distinct hit_id) as hits_with, count(*) as instances, count(v) as with_value, round(avg(v), 6) as value_mean, max(v) as value_max,
    round(100.0 * count(distinct hit_id) / (select count(*) from hits), 3) as hits_with_pct from
    (select hit_id, trim(string_split(t, '=')[1]) as id, try_cast(string_split(t, '=')[2] as double) as v from (select hit_id, unnest(string_split(raw_event_list || ',20', ',')) as t from hits) where trim(t) <> '')
    group by 1 order by 2 desc, 1 limit 40""")
def _(h):
    twice = h.withColumn("raw_event_list", F.concat("raw_event_list", F.lit(",20")))
    return rounded(EV.event_freq(twice, "raw_event_list"), "value_mean", digits=6)


@on_hits("events_per_hit", f"""select hits, hits_with_events, round(100.0 * hits_with_events / hits, 3) as pct_with_events, p50, p95, max_events from
    (select count(*) as hits, {N('n > 0')} as hits_with_events, cast(quantile_disc(n, 0.5) as int) as p50, cast(quantile_disc(n, 0.95) as int) as p95, cast(max(n) as int) as max_events from
    (select coalesce(len({IDS_SQL.format(c='raw_event_list')}), 0) as n from hits))""")
def _(h):
    return EV.events_per_hit(h, "raw_event_list")


@on_hits("ts_daily", f"""select hit_date as date, count(*) as hits, count(distinct {VK}) as visits, count(distinct {PAIR}) as visitors, {N(ELIG)} as clean_hits,
    {N(HOST_LANG_SQL.format(u='url') + ' = $$en$$')} as lang_en, {N(HOST_LANG_SQL.format(u='url') + ' = $$fr$$')} as lang_fr from urls group by 1""", URL)
def _(h):
    lang = U.lang_from_host(url_of(), HOST_LANGS)
    return V.ts_daily(h, F.col("hit_date"), visit(), pair(), P.hit_eligible(), {v: lang == v for v in ("en", "fr")}, exact=True)


@on_hits("ts_daily_approx", "select hit_date as date, count(*) as hits, count(*) > 0 as visits_within, count(*) > 0 as visitors_within from hits group by 1")
def _(h):
    """The same series with sketched distinct counts (one map-side combined aggregate), next to the exact ones."""
    lang = U.lang_from_host(url_of(), HOST_LANGS)

    def series(exact):
        return V.ts_daily(h, F.col("hit_date"), visit(), pair(), P.hit_eligible(), {v: lang == v for v in ("en", "fr")}, exact=exact)

    both = series(False).alias("a").join(series(True).alias("e"), "date")
    return both.select("date", F.col("a.hits").alias("hits"), *[
        _within(F.col(f"a.{c}"), F.col(f"e.{c}"), f"{c}_within") for c in ("visits", "visitors")])


PRESENT = f"present as (select distinct hit_id, hit_date, language, {VK} as vk, unnest({IDS_SQL.format(c='raw_event_list')}) as id from hits)"


@on_hits("ts_events", "select hit_date as date, count(id) filter (where id = '20') as \"20\", count(id) filter (where id = '228') as \"228\" from (select hit_date, null as id from hits union all select hit_date, id from present) group by 1", PRESENT)
def _(h):
    return EV.ts_events(h, "hit_date", "raw_event_list", ["20", "228"])


@on_hits("ts_events_top", """select hit_date as date, id as event_id, count(*) as hits from present where id in (select id from present group by 1 order by count(*) desc, 1 limit 3)
    or id in ('103', '999') group by 1, 2""", PRESENT)
def _(h):
    return EV.ts_events_top(h, "hit_date", "raw_event_list", 3, ["103", "999"])


@on_hits("exclude_source_crosstab", """select exclude_hit, hit_source, count(*) as n, round(100.0 * count(*) / (select count(*) from hits), 3) as pct from hits group by 1, 2""")
def _(h):
    return FQ.crosstab_pct(h, "exclude_hit", "hit_source")


SKEW = "select epoch(try_cast(date_time as timestamp)) - try_cast(hit_time_gmt as bigint) as s from hits"


@on_hits("clock_skew", f"select cast(quantile_disc(s, 0.05) as bigint) as p5, cast(quantile_disc(s, 0.5) as bigint) as p50, cast(quantile_disc(s, 0.95) as bigint) as p95 from ({SKEW}) where s is not null")
def _(h):
    out = FQ.clock_skew(h, F.col("date_time").try_cast("timestamp"), "hit_time_gmt")
    return out.select(*[F.col(c).cast("bigint").alias(c) for c in out.columns])


@on_hits("duplicate_rate", """select count(*) as rows, count(distinct (post_visid_high, post_visid_low, visit_num)) as distinct_keys,
    round(100.0 * (count(*) - count(distinct (post_visid_high, post_visid_low, visit_num))) / count(*), 4) as dup_pct
    from hits where hit_date = (select max(hit_date) from hits where hit_date < (select max(hit_date) from hits))""")
def _(h):
    return FQ.duplicate_rate(h, "hit_date", ["post_visid_high", "post_visid_low", "visit_num"])


@on_hits("late_arrival", "select cast(quantile_disc(l, 0.5) as int) as p50, cast(quantile_disc(l, 0.95) as int) as p95, cast(quantile_disc(l, 0.99) as int) as p99 from (select cast(load_date as date) - hit_date as l from hits)")
def _(h):
    return FQ.late_arrival(h, "load_date", "hit_date")


IDENT = ["mcvisid", "post_visid_high", "post_visid_low", "mobileappid"]


@on_hits("identity_evidence", " union all ".join(
    f"select '{c}' as column_name, round(100.0 * (count(*) - count(v)) / count(*), 3) as blank_pct, count(distinct v) as distinct_values, cast(min(length(v)) as int) as len_min, round(avg(length(v)), 9) as len_avg, cast(max(length(v)) as int) as len_max, count(v) = 0 as all_null, count(distinct v) = 1 as cardinality_1 from (select nullif({c}, '') as v from hits)"
    for c in IDENT))
def _(h):
    return rounded(C.identity_evidence(h, IDENT, exact=True), "len_avg")


@on_hits("daily_ratios", f"""select round(sum(a) / sum(b), 3) as hits_per_visit, round(sum(b) / sum(c), 3) as visits_per_visitor from
    (select count(*) as a, count(distinct {VK}) as b, count(distinct {PAIR}) as c from hits group by hit_date)""")
def _(h):
    return V.daily_ratios(V.traffic_series(h, F.col("hit_date"), "daily", visit(), pair(), exact=True))


@on_hits("event_rate_by_suite", "select rsid, count(*) as rows, round(avg((',' || coalesce(post_event_list, '') || ',' like '%,228,%')::int), 9) as rate from hits group by 1")
def _(h):
    return rounded(EV.event_rate_by_group(h, "rsid", "post_event_list", "228"), "rate")


@on_hits("event_census_by_suite", f"""select rsid, id as event_id, n, rank from (select *, cast(row_number() over (partition by rsid order by n desc, id) as int) as rank from
    (select rsid, id, count(*) as n from (select rsid, unnest({IDS_SQL.format(c='raw_event_list')}) as id from hits) group by 1, 2)) where rank <= 3""")
def _(h):
    return EV.event_census_by_group(h, "rsid", "raw_event_list", 3).select("rsid", "event_id", "n", "rank")


@on_hits("group_nonblank_rates", """select rsid, count(*) as rows, round(avg((coalesce(trim(campaign), '') <> '')::int), 9) as campaign,
    round(avg((coalesce(trim(mobileappid), '') <> '')::int), 9) as mobileappid, null::double as absent from hits group by 1""")
def _(h):
    return rounded(C.group_nonblank_rates(h, "rsid", ["campaign", "mobileappid", "absent"]), "campaign", "mobileappid")


@on_hits("delimiter_probe", " union all ".join(
    f"select '{d}' as delimiter, round(avg(len(string_split(brand_tag, '{d}'))), 9) as avg_parts, round(avg((len(string_split(brand_tag, '{d}')) = 3)::int), 9) as exact_share, {'true' if d == ' | ' else 'false'} as best from hits where brand_tag <> ''"
    for d in (" | ", ":", "-")))
def _(h):
    return rounded(C.delimiter_probe(h, "brand_tag", [" | ", ":", "-"]), "avg_parts", "exact_share")


STEPS = {"20": "View", "228": "Start", "10036": "Flag", "777": "Never"}


@on_hits("funnel_summary", """select s.id as event_id, s.name, count(p.hit_id) as hits, count(distinct vk) as visits, round(count(p.hit_id) * 100.0 / (select count(*) from hits), 4) as pct_of_hits,
    count(distinct hit_date) as active_days, min(hit_date) as first_seen, max(hit_date) as last_seen, count(p.hit_id) > 0 as fires
    from (values ('20', 'View'), ('228', 'Start'), ('10036', 'Flag'), ('777', 'Never')) s(id, name) left join present p on p.id = s.id group by 1, 2""", PRESENT)
def _(h):
    return EV.funnel_summary(h, "hit_date", visit(), "raw_event_list", STEPS)


RATIOS = [("start_over_view", "228", "20"), ("flag_over_start", "10036", "228"), ("never_over_never", "777", "777")]


@on_hits("funnel_ratios", "select r as ratio, round(h_n / greatest(h_d, 1), 4) as hit_basis, round(v_n / greatest(v_d, 1), 4) as visit_basis from ("
         + " union all ".join(f"select '{r}' as r, (select count(*) from present where id = '{n}') as h_n, (select count(*) from present where id = '{d}') as h_d, "
                              f"(select count(distinct vk) from present where id = '{n}') as v_n, (select count(distinct vk) from present where id = '{d}') as v_d" for r, n, d in RATIOS) + ")", PRESENT)
def _(h):
    return EV.funnel_ratios(EV.funnel_summary(h, "hit_date", visit(), "raw_event_list", STEPS), RATIOS)


@on_hits("funnel_by_language", "select language, id as event_id, count(*) as hits from present where id in ('20', '228', '10036') group by 1, 2", PRESENT)
def _(h):
    return EV.funnel_by_language(h, "raw_event_list", ["20", "228", "10036"], F.col("language"))


@on_hits("traffic_series", f"""select cast(date_trunc('week', hit_date) as date) as period, rsid, count(*) as hits, count(distinct {VK}) as visits, count(distinct {PAIR}) as visitors from hits group by 1, 2""")
def _(h):
    return V.traffic_series(h, F.col("hit_date"), "weekly", visit(), pair(), by="rsid", exact=True)


@on_hits("language_mix", f"""select hit_date as period, count(*) as hits, {N('l = $$en$$')} as en, {N('l = $$fr$$')} as fr, round(100.0 * {N('l = $$unknown$$')} / count(*), 3) as other_pct
    from (select hit_date, {HOST_LANG_SQL.format(u='url')} as l from urls) group by 1""", URL)
def _(h):
    return V.language_mix(h, F.col("hit_date"), "daily", U.lang_from_host(url_of(), HOST_LANGS), ["en", "fr"])


@on_hits("event_timeline", "select cast(date_trunc('week', hit_date) as date) as period, id as event_id, count(*) as hits from present where id in ('20', '228') group by 1, 2", PRESENT)
def _(h):
    return V.event_timeline(h, F.col("hit_date"), "weekly", "raw_event_list", ["20", "228"])


@on_orders("monthly_volume", "select strftime(hit_date, '%Y-%m') as month, count(*) as hits from ohits group by 1")
def _(o):
    return V.monthly_volume(o, "hit_date")


ROLLED = " union all ".join(
    f"select '{name}' as grain, {period} as period, count(*) as hits, count(*) > 0 as visits_within, count(*) > 0 as visitors_within from hits group by 2"
    for name, period in (("weekly", "cast(date_trunc('week', hit_date) as date)"), ("monthly", "cast(date_trunc('month', hit_date) as date)")))


@on_hits("traffic_rollup", ROLLED)
def _(h):
    """Weeks and months from a stored table of day sketches, one part of which was processed twice, next to exact counts."""
    spark, path = h.sparkSession, scratch.scratch_path(h.sparkSession, "day-sketches")
    keys = {"visits": visit(), "visitors": pair()}
    fewer = h.where("hit_date < date '2024-01-20' or hit_id % 2 = 0")
    RU.refresh(RU.day_sketches(fewer, "hit_date", keys), path)
    RU.refresh(RU.day_sketches(h.where("hit_date >= date '2024-01-20'"), "hit_date", keys), path, "2024-01-20")
    stored, out = spark.read.parquet(path), None
    for grain in ("weekly", "monthly"):
        exact = V.traffic_series(h, F.col("hit_date"), grain, visit(), pair(), exact=True)
        both = RU.rollup(stored, grain).alias("a").join(exact.alias("e"), "period")
        bound = RU.relative_error()
        rows = both.select(F.lit(grain).alias("grain"), "period", "a.hits", *[
            (F.abs(F.col(f"a.{c}") - F.col(f"e.{c}")) <= F.greatest(bound * F.col(f"e.{c}"), F.lit(1.0))).alias(f"{c}_within") for c in keys])
        out = rows if out is None else out.unionByName(rows)
    return out


@on_hits("population_rollup", f"""select {ELIG} as clean, count(*) as hits, count(*) > 0 as visitors_within from urls
    where hit_date between date '2024-01-05' and date '2024-01-19' group by 1""", URL)
def _(h):
    """A free window per population (clean hits or not) from day sketches, next to exact counts."""
    by = {"clean": P.hit_eligible()}
    sketched = materialize(RU.day_sketches(h, "hit_date", {"visitors": pair()}, by), "population-sketches")
    inside = h.where("hit_date between date '2024-01-05' and date '2024-01-19'")
    exact = C.with_distincts(inside, [F.count(F.lit(1)).alias("hits")], {"visitors": pair()}, True, by)
    both = RU.window(sketched, "2024-01-05", "2024-01-19", ["clean"]).alias("a").join(exact.alias("e"), "clean")
    return both.select("clean", "a.hits", (F.abs(F.col("a.visitors") - F.col("e.visitors")) <= F.greatest(RU.relative_error() * F.col("e.visitors"), F.lit(1.0))).alias("visitors_within"))
