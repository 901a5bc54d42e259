"""Distribution-fidelity checks: the perturbed or scoped hits against the profile of all hits."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.time import epoch_ts
from ..operators import fidelity as FD
from ..operators import inject as N
from ..operators.census import population_census
from ..operators.series import dow_index
from .base import on_hits, on_orders
from .detection import SPIKE, _rank
from .expressions import IDS_SQL
from .filters import INC, INCLUDE, URL, url_of
from .series import DAILY, daily, rounded
from ..functions import predicates as P

SUB = f"sub as (select * from urls where {INC})"


def sub(h):
    return h.where(P.scope_url(url_of(), INCLUDE))


def _spiked(o):
    return N.inject(o, SPIKE)


@on_orders("fid_daily_counts", """select date, b as expected, a as actual, a = b as ok from (select hit_date as date, count(*) as b from ohits group by 1) join
    (select hit_date as date, count(*) + coalesce(sum(copies), 0)::bigint as a from ohits left join (select hit_id, extra // n + case when rk <= extra % n then 1 else 0 end as copies
     from (select *, round_even(n * 1.5::double, 0)::bigint as extra from ranked)) c using (hit_id) group by 1) using (date)""", _rank(SPIKE))
def _(o):
    expected = o.groupBy(F.col("hit_date").alias("date")).agg(F.count(F.lit(1)).alias("hits"))
    return FD.fid_daily_counts(_spiked(o), "hit_date", expected).select("date", "expected", "actual", "ok")


@on_orders("fid_dow_index", """select dow, round(e, 9) as expected, round(m / avg(m) over (), 9) as actual, abs(e - m / avg(m) over ()) < 0.05 as ok from
    (select cast(isodow(date) - 1 as int) as dow, avg(value) / (select avg(value) from daily) as e from daily group by 1) join
    (select cast(isodow(hit_date) - 1 as int) as dow, avg(n) as m from (select hit_date, count(*) as n from ohits where language = 'F' group by 1) group by 1) using (dow)""", *DAILY)
def _(o):
    got = o.where("language = 'F'").groupBy(F.col("hit_date").alias("date")).agg(F.count(F.lit(1)).alias("value"))
    return rounded(FD.fid_dow_index(got, dow_index(daily(o))), "expected", "actual").select("dow", "expected", "actual", "ok")


HOURS = "select cast(isodow(make_timestamp(cast(epoch_text as bigint) * 1000000)) - 1 as int) as dow, (cast(epoch_text as bigint) // 3600) % 24 as hour, count(*) / sum(count(*)) over (partition by dow) as share from {t} group by 1, 2"


@on_hits("fid_hour_shares", f"""select dow, round(d, 9) as mean_delta_pp, d <= case when dow >= 5 then 1.5 else 1.0 end as ok from
    (select coalesce(a.dow, b.dow) as dow, sum(abs(coalesce(a.share, 0) - coalesce(b.share, 0))) / 24 * 100 as d from ({HOURS.format(t='sub')}) a full join ({HOURS.format(t='hits')}) b on a.dow = b.dow and a.hour = b.hour group by 1)""", URL, SUB)
def _(h):
    ts = epoch_ts("epoch_text")
    return rounded(FD.fid_hour_shares(sub(h), ts, FD.hour_shares(h, ts)), "mean_delta_pp")


POPC = ["page_url", "post_page_url", "mobileappid", "campaign"]
_P = "round(100.0 * count(nullif(trim({c}), '')) / count(*), 3)".format


@on_hits("fid_population", " union all ".join(
    f"select '{c}' as column_name, a as actual, e as expected, abs(a - e) < 1.0 as ok from (select {_P(c=c)} as a from sub), (select {_P(c=c)} as e from hits)" for c in POPC), URL, SUB)
def _(h):
    return FD.fid_population(sub(h), population_census(h, POPC), POPC)


DIMS = ["post_evar4", "geo_region", "post_pagename"]
_D = "select {c} as v, count(*) * 100.0::double / (select count(*) from {t}) as s from {t} where trim({c}) <> '' group by 1".format


@on_hits("fid_dims", " union all ".join(
    f"select '{c}' as column_name, 'share' as item, e.v as value, round(e.s, 9) as expected, round(coalesce(a.s, 0), 9) as actual, abs(coalesce(a.s, 0) - e.s) <= 1.5 as ok from (select * from ({_D(c=c, t='hits')}) order by s desc, v limit 10) e left join ({_D(c=c, t='sub')}) a on a.v = e.v "
    f"union all select '{c}', 'coverage', null, round(e, 9), round(a, 9), abs(a - e) <= 1.0 from (select sum(s) as e from ({_D(c=c, t='hits')})), (select sum(s) as a from ({_D(c=c, t='sub')})) "
    f"union all select '{c}', 'distinct', null, e, a, a >= e * 0.8 from (select count(*)::double as e from ({_D(c=c, t='hits')})), (select count(*)::double as a from ({_D(c=c, t='sub')}))" for c in DIMS), URL, SUB)
def _(h):
    return rounded(FD.fid_dims(sub(h), DIMS, *FD.dim_profile(h, DIMS)), "expected", "actual")


_S = f"select coalesce(len({IDS_SQL.format(c='raw_event_list')}), 0) as n from "
_I = f"select id, count(distinct hit_id) * 100.0::double / (select count(*) from {{t}}) as s from (select hit_id, unnest({IDS_SQL.format(c='raw_event_list')}) as id from {{t}}) group by 1"


@on_hits("fid_events", f"""select 'p50' as item, e as expected, a as actual, abs(a - e) <= 1 as ok from (select median(n) as e from ({_S}hits)), (select median(n) as a from ({_S}sub))
    union all select 'p95', e, a, abs(a - e) <= 1 from (select quantile_cont(n, 0.95) as e from ({_S}hits)), (select quantile_cont(n, 0.95) as a from ({_S}sub))
    union all select 'max', e, a, a <= e from (select max(n)::double as e from ({_S}hits)), (select max(n)::double as a from ({_S}sub))
    union all select e.id, round(e.s, 9), round(coalesce(a.s, 0), 9), abs(coalesce(a.s, 0) - e.s) <= 1 from ({_I.format(t='hits')}) e left join ({_I.format(t='sub')}) a on a.id = e.id""", URL, SUB)
def _(h):
    return rounded(FD.fid_events(sub(h), "raw_event_list", *FD.event_profile(h, "raw_event_list")), "expected", "actual")


@on_hits("fid_identity", """select 'duplicate_keys' as item, (count(*) - count(distinct (hit_date, mcvisid, visit_num, visit_page_num)))::double as actual, count(*) = count(distinct (hit_date, mcvisid, visit_num, visit_page_num)) as ok from sub
    union all select 'hits_per_visitor', round(count(mcvisid) / count(distinct mcvisid), 9), true from sub
    union all select 'distinct_visitors', count(distinct mcvisid)::double, count(distinct mcvisid) between 0.9 * (select count(distinct mcvisid) from hits) and 1.1 * (select count(distinct mcvisid) from hits) from sub
    union all select 'misshapen_ids', (count(*) filter (where not regexp_full_match(mcvisid, '[0-9]{1,3}')))::double, count(*) filter (where not regexp_full_match(mcvisid, '[0-9]{1,3}')) = 0 from sub
    union all select 'realistic_mobiledevice', (count(*) filter (where mobiledevice like 'phone%'))::double, false from sub""", URL, SUB)
def _(h):
    want = h.agg(F.count_distinct("mcvisid")).scalar()
    return rounded(FD.fid_identity(sub(h), ["hit_date", "mcvisid", "visit_num", "visit_page_num"], "mcvisid", want, "^[0-9]{1,3}$",
                                   {"mobiledevice": "^phone"}), "actual")


@on_hits("fid_clock_skew", """select item, expected, actual, actual::int = expected as ok from (select unnest(['p5', 'p50', 'p95']) as item, unnest([-18000.0::double, -17000, -14000]) as expected, unnest(quantile_cont(s, [0.05, 0.5, 0.95])) as actual
    from (select (epoch(try_cast(date_time as timestamp)) - try_cast(hit_time_gmt as bigint))::bigint as s from hits) where s is not null)""")
def _(h):
    return FD.fid_clock_skew(h, F.col("date_time").try_cast("timestamp"), "hit_time_gmt", (-18000, -17000, -14000))


@on_hits("fid_summary", "select 'population' as check, 4::bigint as items, count(*) filter (where not ok) as failed, case when count(*) filter (where not ok) = 0 then 'PASS' else 'FAIL' end as status from ("
         + " union all ".join(f"select abs(a - e) < 1.0 as ok from (select {_P(c=c)} as a from sub), (select {_P(c=c)} as e from hits)" for c in POPC) + ")", URL, SUB)
def _(h):
    return FD.summary(FD.fid_population(sub(h), population_census(h, POPC), POPC), "population")
