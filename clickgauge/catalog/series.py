"""Window functions and time-series operators."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.time import epoch_ts, local_ts
from ..functions.url import host_path, url_host
from ..operators import series as S
from ..operators.calendar import calendar_spine, stack_on_calendar
from ..operators.kpi import daily_hits
from .base import on_hits, on_orders, on_pages
from .expressions import PARTS, PATHS
from .kpis import CAL, OLONG, order_long

DAILY = (CAL.format(t="ohits"),
         "daily as (select date, cast(count(hit_date) as double) as value from cal left join ohits on date = hit_date group by 1)")


def daily(o):
    spine = calendar_spine(o, "hit_date")
    return stack_on_calendar(spine, [daily_hits(o, "hit_date")], ["hits"]).select(
        "date", F.col("hits").cast("double").alias("value"))


def rounded(df, *cols, digits=9):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


@on_hits("top_per_group", """select rsid, post_pagename, n, rank from (select *, cast(row_number() over (partition by rsid order by n desc, post_pagename) as int) as rank
    from (select rsid, coalesce(post_pagename, '<null>') as post_pagename, count(*) as n from hits group by 1, 2)) where rank <= 3""")
def _(h):
    n = h.groupBy("rsid", F.coalesce("post_pagename", F.lit("<null>")).alias("post_pagename")).agg(F.count(F.lit(1)).alias("n"))
    return S.top_per_group(n, "rsid", 3, "n", "post_pagename")


@on_pages("cumulative_pct", """select host, n, round(100.0 * n / total, 3) as pct, round(100.0 * sum(n) over (order by n desc, host rows unbounded preceding) / total, 3) as cumulative_pct
    from (select host, count(*) as n, sum(count(*)) over () as total from paths group by 1 order by n desc, host limit 20)""", PARTS, PATHS)
def _(p):
    n = p.groupBy(url_host(host_path("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))
    return S.cumulative_pct(n, 20, "n", "host")


@on_orders("dod_jumps", """select date, value, prev, round(l, 9) as abs_log_ratio from (select *, abs(ln(value / prev)) as l from
    (select date, value, lag(value) over (order by date) as prev from daily where value > 0) where prev is not null) order by round(l, 9) desc, date limit 5""", *DAILY)
def _(o):
    return rounded(S.dod_jumps(daily(o)), "abs_log_ratio")


BASE_SQL = """case when count(*) over (partition by metric_id, isodow(date) order by date rows between unbounded preceding and 1 preceding) >= 2
    then median({v}) over (partition by metric_id, isodow(date) order by date rows between 4 preceding and 1 preceding) end"""


@on_orders("seasonal_baseline", f"select date, metric_id, round({BASE_SQL.format(v='value')}, 9) as baseline from olong", *OLONG)
def _(o):
    long = order_long(o)
    return rounded(long.select("date", "metric_id", S.seasonal_baseline(long, "value").alias("baseline")), "baseline")


@on_orders("rolling_means", """select date, metric_id, round(avg(value) over (partition by metric_id order by date rows between 6 preceding and current row), 7) as post,
    round(avg(value) over (partition by metric_id order by date rows between 27 preceding and 7 preceding), 7) as pre from olong""", *OLONG)
def _(o):
    long = order_long(o)
    post, pre = S.rolling_means(long, "value")
    return rounded(long.select("date", "metric_id", post.alias("post"), pre.alias("pre")), "post", "pre", digits=7)


@on_orders("centered_shift", """select date, value, roll, prev, round(abs(ln(roll / prev)), 9) as abs_log_ratio from
    (select *, lag(roll, 7) over (order by date) as prev from (select date, value, case when count(*) over w = 7 then median(value) over w end as roll
     from daily window w as (order by date rows between 3 preceding and 3 following))) where roll > 0 and prev > 0 and abs(ln(roll / prev)) > ln(1.3)
    order by round(abs(ln(roll / prev)), 9) desc, date limit 5""", *DAILY)
def _(o):
    return rounded(S.centered_shift(daily(o)), "abs_log_ratio")


@on_orders("autocorr", """select round(corr(v, y7), 7) as autocorr_7, round((select corr(v, y28) from (select value as v, lag(value, 28) over (order by date) as y28 from daily)), 7) as autocorr_28
    from (select value as v, lag(value, 7) over (order by date) as y7 from daily)""", *DAILY)
def _(o):
    from ..operators.joins import combine_single_rows
    d = daily(o)
    both = combine_single_rows(S.autocorr(d, 7), S.autocorr(d, 28))
    return rounded(both, "autocorr_7", "autocorr_28", digits=7)


@on_orders("coef_variation", "select metric_id, round(stddev_samp(value) / avg(value), 9) as cv from olong group by 1 having avg(value) <> 0 union all select metric_id, null from olong group by 1 having avg(value) = 0", *OLONG)
def _(o):
    return rounded(S.coef_variation(order_long(o)), "cv")


@on_orders("dow_index", "select cast(isodow(date) - 1 as int) as dow, round(avg(value) / (select avg(value) from daily), 9) as dow_index from daily group by 1", *DAILY)
def _(o):
    return rounded(S.dow_index(daily(o)), "dow_index")


@on_orders("dow_mean", "select cast(isodow(date) - 1 as int) as dow, round(avg(value), 9) as mean from daily group by 1", *DAILY)
def _(o):
    return rounded(S.dow_mean(daily(o)), "mean")


@on_hits("dow_hour_profile", """select cast(isodow(d) - 1 as int) as dow, cast(h as int) as hour, round(avg(n), 9) as mean_hits from
    (select hit_date as d, (try_cast(epoch_text as bigint) // 3600) % 24 as h, count(*) as n from hits where hit_date >= (select max(hit_date) - 14 from hits) group by 1, 2) group by 1, 2""")
def _(h):
    return rounded(S.dow_hour_profile(h, epoch_ts("epoch_text"), 14), "mean_hits")


@on_hits("dow_hour_total", """select cast(isodow(t) - 1 as int) as dow, cast(extract(hour from t) as int) as hour, count(*) as hits from
    (select make_timestamp((cast(epoch_text as bigint) - 18000) * 1000000) as t from hits) group by 1, 2""")
def _(h):
    return S.dow_hour_total(h, local_ts("epoch_text", "America/Toronto"))


@on_orders("monthly_totals", "select strftime(hit_date, '%Y-%m') as month, count(*) as total, count(*) filter (where language = 'F') as scoped from ohits group by 1")
def _(o):
    return S.monthly_totals(o, "hit_date", F.col("language") == "F")


@on_orders("missing_days", """select date from cal where date not in (select hit_date from ohits where language = 'F')
    and date between (select min(hit_date) from ohits where language = 'F') and (select max(hit_date) from ohits where language = 'F')""", CAL.format(t="ohits"))
def _(o):
    n = o.groupBy(F.col("hit_date").alias("date")).agg(F.count(F.when(F.col("language") == "F", 1)).alias("value"))
    return S.missing_days(n)


@on_orders("series_stats", """select metric_id, round(sum(value), 6) as total, count(*) as days, count(*) filter (where value > 0) as days_nonzero,
    count(*) filter (where not value > 0) as days_zero, min(value) as min, percentile_disc(0.5) within group (order by value desc) as p50, max(value) as max
    from olong where metric_id not like '%share%' and metric_id not like '%rate' and metric_id <> 'pv_per_visit' group by 1""", *OLONG)
def _(o):
    counts = order_long(o).where("metric_id not like '%share%' and metric_id not like '%rate' and metric_id <> 'pv_per_visit'")
    return rounded(S.series_stats(counts), "total", digits=6)
