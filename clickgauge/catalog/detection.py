"""Detectors, rules, evaluation and labelled perturbations."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from ..operators import detect as D
from ..operators import evaluate as E
from ..operators import inject as N
from ..operators import rules as RU
from ..plans.registry import Thresholds
from ..sources.scratch import materialize
from .base import on_hits, on_orders
from .kpis import OLONG, ORDER_REG, order_gold
from .series import BASE_SQL, rounded

COUNTS = ", ".join(f"'{m}'" for m in ORDER_REG.count_metrics)
SCORED = ", ".join(f"'{s.metric_id}'" for s in ORDER_REG.scored)
VOLUME = "'hits_total', 'visits_total', 'visitors_total'"
REGION = (
    *OLONG,
    f"r1 as (select date, metric_id, value, row_number() over (partition by metric_id order by date) - 1 as idx, count(*) over (partition by metric_id) as n_days, "
    f"min(value) over (partition by metric_id) = max(value) over (partition by metric_id) as is_constant, "
    f"case when metric_id in ({COUNTS}) then ln(1 + value) else value end as v from olong where metric_id in ({SCORED}))",
    f"r2 as (select *, {BASE_SQL.format(v='v')} as baseline from r1)",
    "region as (select *, case when idx >= floor(n_days * 0.2::double) and baseline is not null then v - baseline end as resid from r2)",
    "st as (select metric_id, median(resid) as med, stddev_pop(resid) as sd, quantile_cont(abs(resid), 0.99) as q from region group by 1)",
    "ms as (select metric_id, case when 1.4826 * median(abs(resid - med)) > 1e-12 then 1.4826 * median(abs(resid - med)) else any_value(sd) end as scale, any_value(med) as med, any_value(q) as q from region join st using (metric_id) group by 1)",
    "zs as (select r.*, scale, q, case when resid is null then null when scale > 1e-12 then (resid - med) / scale else 0.0 end as z from region r join ms using (metric_id))",
    "uni as (select * from zs where n_days >= 21 and not is_constant and (abs(z) >= 3.5 or (abs(resid) >= q and abs(z) >= 3.0)))",
    f"ls as (select *, avg(v) over (w rows between 6 preceding and current row) as post, avg(v) over (w rows between 27 preceding and 7 preceding) as pre from zs where metric_id in ({VOLUME}) window w as (partition by metric_id order by date))",
    "shift as (select *, (post - pre) / (scale * sqrt(1/7.0 + 1/21.0)) as zz from ls where scale > 1e-12 and idx >= greatest(28, floor(n_days * 0.2::double)))",
    f"feat as (select date, metric_id, case when metric_id in ({COUNTS}) then ln(1 + value) else value end as x from olong where metric_id in ({SCORED}))",
    "mom as (select metric_id, sum(power(x - m, 3)) as third from feat join (select metric_id, avg(x) as m from feat group by 1) using (metric_id) group by 1)",
    "tails as (select date, metric_id, x, -ln(cume_dist() over (partition by metric_id order by x)) as u_l, -ln(cume_dist() over (partition by metric_id order by x desc)) as u_r, third from feat join mom using (metric_id))",
    "tails2 as (select *, case when third < 0 then u_l when third > 0 then u_r else u_l + u_r end as u_s from tails)",
    "days as (select date, greatest(sum(u_l), sum(u_r), sum(u_s)) as o, sum(greatest(u_s, (u_l + u_r) / 2)) as c, sum(greatest(u_l, u_r, u_s)) as e from tails2 group by 1)",
    "dz as (select d.date, o, case when sc > 1e-12 then (o - med) / sc else 0.0 end as z from days d, (select median(o) as med from days), (select case when 1.4826 * mad > 1e-12 then 1.4826 * mad else sd end as sc from (select median(abs(o - (select median(o) from days))) as mad, stddev_pop(o) as sd from days)))",
)
SEV = "case when {z} >= 12 then 'critical' when {z} >= 8 then 'major' when {z} >= 5 then 'minor' else 'warn' end"
SEGMENT = " ".join(f"when '{s.metric_id}' then '{s.segment}'" for s in ORDER_REG.scored if s.segment)
STAMP = "2001-08-02T00:00:00+00:00"


def _row_sql(src, detector, cls, uri, metric, segment, obs, exp, score, thr, sev):
    return (f"select {metric} || ':' || cast(date as string) || ':{detector}' as anomaly_id, '{STAMP}' as detected_at, date, 'batch-rescan' as plane, 'web' as domain, "
            f"{metric} as metric_id, cast({segment} as string) as segment, {obs} as observed, cast({exp} as double) as expected, cast({score} as double) as score, "
            f"cast({thr} as double) as threshold, {sev} as severity, "
            f"'{cls}' as class, '{uri}' as model_uri, '{detector}' as detector, false as reconciled, 'open' as status from {src}")


def _back(c):
    return f"round(case when metric_id in ({COUNTS}) then exp({c}) - 1 else {c} end, 4)"


UNI_SQL = _row_sql("uni", "univariate", "business", "local:seasonal_dow_median", "metric_id", f"case metric_id {SEGMENT} end",
                   _back("v"), _back("baseline"), "round(abs(z), 3)", "3.5::double", SEV.format(z="abs(z)"))
SHIFT_SQL = _row_sql("shift where abs(zz) >= 4.0", "level_shift", "business", "local:cusum.seasonal_resid", "metric_id", "null",
                     _back("post"), _back("pre"), "round(abs(zz), 3)", "4.0::double", SEV.format(z="abs(zz)"))
MV_SQL = _row_sql("dz where z >= 3.5", "multivariate", "business", "local:ecod", "'mv_daily_kpi_vector'", "null",
                  "round(o, 4)", "null", "round(z, 3)", "3.5::double", SEV.format(z="z"))
ZERO_SQL = _row_sql("olong where metric_id = 'hits_total' and value = 0", "zero_volume", "operational", "local:rule.zero_volume",
                    "metric_id", "null", "0.0::double", "null", "null", "null", "'critical'")
COVER_SQL = _row_sql("(select *, avg((value > 0)::int) over (partition by metric_id) as act from olong where metric_id like 'event\\_%\\_count' escape '\\') where act >= 0.9 and value = 0",
                     "event_coverage", "operational", "local:rule.event_coverage", "metric_id", "null", "0.0::double", "null", "null", "null", "'critical'")


def dim_ctes(hits, dims):
    union = " union all ".join(f"select '{d}' as dim, hit_date as date, coalesce({d}, '') as value from {hits}" for d in dims)
    return (f"dimrows as ({union})",
            "dimcnt as (select dim, date, value, count(*) as n, sum(count(*)) over (partition by dim, date) as total from dimrows group by 1, 2, 3)",
            "dimday as (select dim, date, row_number() over (partition by dim order by date) - 1 as k, share from (select dim, date, sum(case when value = '' then n else 0 end) / sum(n) as share from dimcnt group by 1, 2))",
            "blank as (select *, median(share) over (partition by dim order by date rows between 28 preceding and 1 preceding) as base from dimday)",
            "vals as (select c.dim, c.date, c.value, n / total as share, k, lag(k) over (partition by c.dim, c.value order by k) as last_k from dimcnt c join dimday d on c.dim = d.dim and c.date = d.date where c.value <> '')")


BLANK_SQL = _row_sql("blank where k >= 14 and share - base > 0.1", "dim_coverage", "operational", "local:rule.dim_coverage",
                     "dim || '_blank_rate'", "null", "round(share, 4)", "round(base, 4)", "null", "null", "'major'")
NEW_SQL = _row_sql("vals where k >= {tr} and share > 0.01 and (last_k is null or k - last_k > {tr})", "dim_coverage", "operational", "local:rule.dim_coverage",
                   "dim || '_new_value'", "value", "round(share, 4)", "0.0::double", "null", "null", "'major'")
ODIMS = dim_ctes("ohits", ORDER_REG.rule_dims)


def stamped(df):
    return df.withColumn("detected_at", F.lit(STAMP))


@on_orders("robust_z", """select date, metric_id, round(case when s > 1e-12 then (value - med) / s else 0.0 end, 7) as z from
    (select o.date, o.metric_id, o.value, med, case when mad > 1e-12 then mad else sd end as s from olong o join
    (select metric_id, any_value(med) as med, 1.4826 * median(abs(value - med)) as mad, stddev_pop(value) as sd from olong
     join (select metric_id, median(value) as med from olong group by 1) using (metric_id) group by 1) using (metric_id))""", *OLONG)
def _(o):
    return rounded(D.robust_z(order_gold(o)).select("date", "metric_id", "z"), "z", digits=7)


@on_orders("scored_region", "select date, metric_id, idx, round(baseline, 9) as baseline, round(resid, 9) as resid from region", *REGION)
def _(o):
    df = D.scored_region(order_gold(o), ORDER_REG).select("date", "metric_id", F.col("idx").cast("long").alias("idx"), "baseline", "resid")
    return rounded(df, "baseline", "resid")


@on_orders("quantile_gate", "select date, metric_id, coalesce(abs(resid) >= q and abs(z) >= 3.0, false) as gated from zs", *REGION)
def _(o):
    df = D.with_robust_z(D.scored_region(order_gold(o), ORDER_REG), "resid", Window.partitionBy("metric_id"))
    return D.quantile_gate(df).select("date", "metric_id", F.coalesce("gated", F.lit(False)).alias("gated"))


@on_orders("detect_univariate", UNI_SQL, *REGION)
def _(o):
    return stamped(D.detect_univariate(order_gold(o), ORDER_REG))


@on_orders("anomaly_row", UNI_SQL, *REGION)
def _(o):
    return stamped(D.detect_univariate(order_gold(o), ORDER_REG)).select(*D.ANOMALY_COLUMNS)


@on_hits("anomaly_row_busy_suite", _row_sql("busy where v > m", "busy_suite", "operational", "local:example", "metric_id", "seg", "round(v, 4)", "round(m, 4)", "round(v / m, 3)", "1.0::double",
                                 "case when v > 1.2 * m then 'major' else 'minor' end"),
         "busy as (select hit_date as date, 'hits_' || rsid as metric_id, rsid as seg, count(*)::double as v, (select avg(n) from (select count(*) as n from hits group by hit_date, rsid)) as m from hits group by hit_date, rsid)")
def _(h):
    """The canonical columns around findings of a caller's own: suites on days busier than the mean."""
    days = h.groupBy(F.col("hit_date").alias("date"), "rsid").agg(F.count(F.lit(1)).cast("double").alias("v"))
    m = days.agg(F.avg("v")).scalar()
    v = F.col("v")
    found = D.anomaly_row(days.withColumn("m", m).where("v > m"), "busy_suite", cls="operational", model_uri="local:example", observed=v, expected=F.col("m"), score=v / F.col("m"),
                          threshold=1.0, level=F.when(v > 1.2 * F.col("m"), "major").otherwise("minor"), segment=F.col("rsid"), metric=F.concat(F.lit("hits_"), "rsid"))
    return stamped(found).select(*D.ANOMALY_COLUMNS)


@on_orders("level_shift_scores", "select date, metric_id, round(zz, 6) + 0.0 as z from shift", *REGION)
def _(o):
    return rounded(D.level_shift_scores(order_gold(o), ORDER_REG).select("date", "metric_id", "z"), "z", digits=6)


LOOSE = Thresholds(ls_z=2.0)


@on_orders("detect_level_shift", SHIFT_SQL.replace(">= 4.0", ">= 2.0").replace("4.0::double", "2.0::double"), *REGION)
def _(o):
    return stamped(D.detect_level_shift(order_gold(o), ORDER_REG, LOOSE))


@on_orders("feature_matrix", "select date, metric_id, round(x, 9) as x from feat", *REGION)
def _(o):
    return rounded(D.feature_matrix(order_gold(o), ORDER_REG), "x")


@on_orders("ecod_scores", "select date, round(o, 6) as ecod, round(e, 6) as per_feature, round(c, 6) as copod from days", *REGION)
def _(o):
    long = order_gold(o)
    a, b, c = (D.multivariate_scores(long, ORDER_REG, m).withColumnRenamed("outlier_score", n)
               for m, n in (("ecod", "ecod"), ("ecod_per_feature", "per_feature"), ("copod", "copod")))
    return rounded(a.join(b, "date").join(c, "date"), "ecod", "per_feature", "copod", digits=6)


@on_orders("detect_ecod", MV_SQL, *REGION)
def _(o):
    return stamped(D.detect_multivariate(order_gold(o), ORDER_REG))


@on_orders("detect_copod", MV_SQL.replace("round(o, 4)", "round(c, 4)").replace("local:ecod", "local:copod"), *REGION[:-1],
           REGION[-1].replace("d.date, o,", "d.date, c,").replace("(o - med)", "(c - med)").replace("median(o)", "median(c)").replace("abs(o -", "abs(c -").replace("pop(o)", "pop(c)"))
def _(o):
    return stamped(D.detect_multivariate(order_gold(o), ORDER_REG, method="copod"))


@on_orders("scored_subset", "select metric_id, count(*) as days from olong where metric_id not like 'pv%' and metric_id <> 'page_views_total' group by 1", *OLONG)
def _(o):
    scored = [s.metric_id for s in ORDER_REG.scored]
    return order_gold(o).where(F.col("metric_id").isin(scored)).groupBy("metric_id").agg(F.count(F.lit(1)).alias("days"))


ALL_SQL = " union all ".join([UNI_SQL, SHIFT_SQL, MV_SQL, ZERO_SQL, COVER_SQL, BLANK_SQL, NEW_SQL.format(tr=28)])


def all_findings(o, long=None):
    """Findings as published: a table that scoring reads."""
    long = order_gold(o) if long is None else long
    parts = [D.detect_univariate(long, ORDER_REG), D.detect_level_shift(long, ORDER_REG),
             D.detect_multivariate(long, ORDER_REG), RU.run_rules(long, o, ORDER_REG)]
    return materialize(D.anomaly_union(parts, STAMP), "anomalies")


FOUND = (*REGION, *ODIMS, f"found as ({ALL_SQL})")


@on_orders("anomaly_union", "select * from found", *FOUND)
def _(o):
    return all_findings(o)


@on_orders("counts_by_detector", "select detector, count(*) as rows, count(distinct date) as days from found group by 1", *FOUND)
def _(o):
    return D.counts_by_detector(all_findings(o))


DENOM = ("den as (select 'business' as class, 'univariate' as detector, (select count(*) from (select metric_id from region group by 1 having not any_value(is_constant))) * (nd - floor(nd * 0.2::double))::bigint as denominator from (select max(n_days) as nd from region) "
         "union all select 'business', 'level_shift', 3 * (nd - floor(nd * 0.2::double))::bigint from (select max(n_days) as nd from region) "
         "union all select 'business', 'multivariate', (select max(n_days) from region) "
         "union all select 'operational', 'zero_volume', (select max(n_days) from region) "
         "union all select 'operational', 'event_coverage', (select max(n_days) from region) * (select count(*) from (select metric_id from olong where metric_id like 'event\\_%\\_count' escape '\\' group by 1 having avg((value > 0)::int) >= 0.9)) "
         "union all select 'operational', 'dim_coverage', 2 * ((select max(n_days) from region) - 14))")


@on_orders("fp_denominators", "select * from den", *REGION, DENOM)
def _(o):
    return D.fp_denominators(order_gold(o), ORDER_REG)


# ---------------------------------------------------------------- rules

@on_orders("rule_zero_volume", ZERO_SQL, *OLONG)
def _(o):
    return stamped(RU.rule_zero_volume(order_gold(o)))


@on_orders("rule_event_coverage", COVER_SQL.replace(">= 0.9", ">= 0.2"), *OLONG)
def _(o):
    return stamped(RU.rule_event_coverage(order_gold(o), ORDER_REG, Thresholds(min_active_frac=0.2)))


HDIMS = ("post_pagename", "language", "ref_type", "browser", "va_closer_id")


@on_hits("rule_blank_jump", BLANK_SQL, *dim_ctes("hits", HDIMS))
def _(h):
    return stamped(RU.rule_blank_jump(RU.dim_day_counts(h, "hit_date", HDIMS)))


@on_hits("rule_new_value", NEW_SQL.format(tr=10), *dim_ctes("hits", HDIMS))
def _(h):
    return stamped(RU.rule_new_value(RU.dim_day_counts(h, "hit_date", HDIMS), Thresholds(trailing_days=10)))


@on_orders("run_rules", " union all ".join([ZERO_SQL, COVER_SQL, BLANK_SQL, NEW_SQL.format(tr=28)]), *OLONG, *ODIMS)
def _(o):
    return stamped(RU.run_rules(order_gold(o), o, ORDER_REG))


# ---------------------------------------------------------------- perturbations

SPIKE = N.Scenario("spike_day", "spike", "hits", "1998-03-01", "1998-03-31", 2.5)
SHIFT = N.Scenario("shift_days", "level_shift", "hits", "1999-04-01", "1999-05-30", 1.9)
DIP = N.Scenario("dip_days", "dip", "hits", "1997-05-01", "1997-06-30", 0.4)
MIX = N.Scenario("mix_days", "dim_mix_shift", "pagename_share", "1996-06-10", "1996-08-12", 0.20,
                 dim="post_pagename", value="1-URGENT")
DROP = N.Scenario("drop_days", "event_drop", "event_3_rate", "2000-03-24", "2000-05-26", 1.0, event_id="3")
SCENARIOS = [SPIKE, SHIFT, DIP, MIX, DROP]


def _win(s):
    return f"hit_date between date '{s.start}' and date '{s.end}'"


def _rank(s, tbl="ohits"):
    return (f"ranked as (select *, row_number() over (order by md5(cast(hit_id as string)), hit_id) as rk, count(*) over () as n from {tbl} where {_win(s)})")


def _volume_sql(s):
    return (f"select cast(hit_id as string) as hit_id, hit_date from ohits union all "
            f"select cast(hit_id as string) || '+' || cast(c as string), hit_date from (select *, unnest(generate_series(1, copies)) as c from "
            f"(select *, extra // n + case when rk <= extra % n then 1 else 0 end as copies from (select *, round_even(n * {s.magnitude - 1}::double, 0)::bigint as extra from ranked)))")


def _volume(o, s):
    return N.inject(o, s).select("hit_id", "hit_date")


@on_orders("inject_spike", _volume_sql(SPIKE), _rank(SPIKE))
def _(o):
    return _volume(o, SPIKE)


@on_orders("inject_level_shift", _volume_sql(SHIFT), _rank(SHIFT))
def _(o):
    return _volume(o, SHIFT)


KEEP = f"substr(md5(cast(hit_id as string)), 1, 8) < '{int(round(0.4 * 2 ** 32)):08x}'"


@on_orders("inject_dip", f"select hit_id, hit_date from ohits where not {_win(DIP)} or {KEEP}")
def _(o):
    return N.inject(o, DIP).select("hit_id", "hit_date")


@on_orders("inject_dim_mix", f"""select hit_id, post_pagename from ohits where not {_win(MIX)} union all
    select hit_id, case when rk <= round_even(n * 0.2::double, 0) then '1-URGENT' else post_pagename end from ranked""", _rank(MIX))
def _(o):
    return N.inject(o, MIX).select("hit_id", "post_pagename")


@on_orders("inject_event_drop", f"""select hit_id, case when {_win(DROP)} and post_event_list = '3' then '' else post_event_list end as post_event_list from ohits""")
def _(o):
    return N.inject(o, DROP).select("hit_id", "post_event_list")


@on_orders("realized_effect", f"""select 'mix_days' as anomaly_id, n as hits_before, n as hits_after, 1.0::double as realized_ratio,
    round(b / n, 4) as share_before, round(a / n, 4) as share_after, round((a - b) / n * 100, 2) as realized_delta_pp, null::double as rate_before, null::double as rate_after from
    (select count(*) as n, count(*) filter (where post_pagename = '1-URGENT') as b, count(*) filter (where post_pagename = '1-URGENT' or rk <= round_even(n * 0.2::double, 0)) as a from ranked)""", _rank(MIX))
def _(o):
    return N.realized_effect(o, N.inject(o, MIX), MIX)


# ---------------------------------------------------------------- evaluation

MANIFEST_SQL = "manifest as (select * from (values " + ", ".join(
    f"('{s.anomaly_id}', '{s.type}', date '{s.start}', date '{s.end}', " +
    (f"['pagename_share_1-urgent', 'mv_daily_kpi_vector']" if s.type == "dim_mix_shift" else
     f"['event_3_count', 'event_3_rate']" if s.type == "event_drop" else
     "['hits_total', 'visits_total', 'visitors_total', 'mv_daily_kpi_vector']") + ")" for s in SCENARIOS) + \
    ") as m(scenario, type, d0, d1, metrics))"
KNOWN = ["1995-03-01", "1996-07-02", "2000-09-09"]


def known(o):
    days = o.sparkSession.createDataFrame([(d,) for d in KNOWN], "d string")
    return days.select(F.col("d").cast("date").alias("date"))


@on_orders("relevant_metrics", "select scenario, unnest(metrics) as metric_id, (select count(*) from ohits where hit_date between d0 and d1) as hits from manifest", MANIFEST_SQL)
def _(o):
    m = N.manifest(o.sparkSession, SCENARIOS)
    cells = m.select(F.col("anomaly_id").alias("scenario"), "date_start", "date_end",
                     F.explode(E.relevant_metrics(F.col("type"), F.col("scope"))).alias("metric_id"))
    days = o.groupBy(F.col("hit_date").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return (E.window_days(cells).join(days, "date", "left").groupBy("scenario", "metric_id")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("hits")))


RECALL_SQL = """select scenario, type, count(f.detector) > 0 as detected, coalesce(array_to_string(list_sort(list(distinct f.detector) filter (where f.detector is not null)), ','), '') as detectors,
    cast(min(f.date) - any_value(d0) as int) as delay_days, count(f.detector) as flags_in_window
    from manifest m left join found f on f.date between d0 and d1 and list_contains(metrics, f.metric_id) group by 1, 2"""


def _recall(o):
    out = E.score_recall(all_findings(o), N.manifest(o.sparkSession, SCENARIOS))
    return out.withColumn("detectors", F.array_join("detectors", ","))


@on_orders("score_recall", RECALL_SQL, *FOUND, MANIFEST_SQL)
def _(o):
    return _recall(o)


@on_orders("recall_range_join", RECALL_SQL, *FOUND, MANIFEST_SQL)
def _(o):
    return _recall(o)


@on_orders("recall_findings", """select scenario, type, f.date, f.metric_id, f.detector, cast(f.date - d0 as int) as day from manifest
    join found f on f.date between d0 and d1 and list_contains(metrics, f.metric_id)""", *FOUND, MANIFEST_SQL)
def _(o):
    met = E.recall_range_join(all_findings(o), N.manifest(o.sparkSession, SCENARIOS))
    return met.select("scenario", "type", "date", "metric_id", "detector", F.datediff("date", "date_start").alias("day"))


OUTSIDE = ("not exists (select 1 from manifest where f.date between d0 and d1) and f.date not in ("
           + ", ".join(f"date '{d}'" for d in KNOWN) + ")")


@on_orders("fp_range_anti", f"select anomaly_id from found f where {OUTSIDE}", *FOUND, MANIFEST_SQL)
def _(o):
    out = E.excluded_days(N.manifest(o.sparkSession, SCENARIOS), known(o))
    return E.false_positives(all_findings(o), out).select("anomaly_id")


@on_orders("score_fp", f"""select class, coalesce(fp, 0) as flagged_fp, denominator, round(coalesce(fp, 0) / nullif(denominator, 0), 5) as rate from
    (select class, sum(denominator)::bigint as denominator from den group by 1) left join (select class, count(*) as fp from found f where {OUTSIDE} group by 1) using (class)""",
           *FOUND, MANIFEST_SQL, DENOM)
def _(o):
    out = E.excluded_days(N.manifest(o.sparkSession, SCENARIOS), known(o))
    long = order_gold(o)
    return E.score_fp(all_findings(o, long), D.fp_denominators(long, ORDER_REG), out)


@on_orders("control_known_events", "select d as date, d in (select date from found where metric_id in ('hits_total', 'visits_total', 'visitors_total', 'mv_daily_kpi_vector')) as flagged from (select unnest(["
           + ", ".join(f"date '{d}'" for d in KNOWN) + "]) as d)", *FOUND)
def _(o):
    return E.control_known_events(all_findings(o), known(o))
