"""Time-series operators over daily frames.

A daily frame is [date, value] or, for many series at once, [date, metric_id, value]. All
windows are partitioned by series. A series has one row per calendar day, so a window
partition is bounded by the length of the history, never by the number of hits.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import as_col, count_where, pct
from .calendar import calendar_spine
from .census import top_n

SERIES = ("metric_id",)


def _series(df: DataFrame, keys=SERIES):
    have = [k for k in keys if k in df.columns]
    return Window.partitionBy(*have) if have else Window.partitionBy(F.lit(1))


def _keys(df: DataFrame) -> list[str]:
    return [k for k in SERIES if k in df.columns]


def upper_median(c: str) -> Column:
    """Element n // 2 of the sorted values: a value that occurs, the upper one when n is even."""
    return F.expr(f"percentile_disc(0.5) within group (order by `{c}` desc)")


def median_of(c: Column) -> Column:
    return F.percentile(c, F.lit(0.5))


def top_per_group(df: DataFrame, group: str, k: int, by: str = "n", *tie: str) -> DataFrame:
    """Largest ``k`` rows of every group. Spark trims each map task to ``k`` rows per group
    before the shuffle (window group limit), so a hot group costs no more than others."""
    w = Window.partitionBy(group).orderBy(F.desc(by), *tie)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def cumulative_pct(df: DataFrame, k: int, by: str = "n", *tie: str) -> DataFrame:
    """Top ``k`` rows with their share of *all* rows and the running share.

    The total is a scalar subquery over the same aggregate; only the ``k`` survivors are
    windowed.
    """
    total = df.agg(F.sum(by)).scalar()
    top = top_n(df, k, by, *tie)
    run = Window.partitionBy(F.lit(1)).orderBy(F.desc(by), *tie).rowsBetween(Window.unboundedPreceding, 0)
    ranked = top.withColumn("pct", pct(F.col(by), total)).withColumn("_run", F.sum(by).over(run))
    return ranked.withColumn("cumulative_pct", pct(F.col("_run"), total)).drop("_run")


def dod_jumps(daily: DataFrame, k: int = 5) -> DataFrame:
    """Largest absolute log ratios between consecutive positive days."""
    w = _series(daily).orderBy("date")
    positive = daily.where(F.col("value") > 0)
    steps = positive.withColumn("prev", F.lag("value").over(w)).where("prev is not null")
    steps = steps.withColumn("abs_log_ratio", F.abs(F.ln(F.col("value") / F.col("prev"))))
    return top_n(steps, k, "abs_log_ratio", "date")


def weekday(c: str = "date") -> Column:
    """Monday is 0."""
    return F.weekday(c)


def seasonal_baseline(df: DataFrame, value: str, window: int = 4, min_history: int = 2) -> Column:
    """Median of the last ``window`` same-weekday values before the day; NULL until enough."""
    by_dow = Window.partitionBy(*_keys(df), weekday()).orderBy("date")
    prior = by_dow.rowsBetween(Window.unboundedPreceding, -1)
    recent = by_dow.rowsBetween(-window, -1)
    return F.when(F.count(value).over(prior) >= min_history, F.percentile(value, F.lit(0.5)).over(recent))


def rolling_means(df: DataFrame, value: str, post: int = 7, pre: int = 21) -> tuple[Column, Column]:
    """Mean of the last ``post`` rows, and of the ``pre`` rows before those."""
    w = _series(df).orderBy("date")
    return (F.avg(value).over(w.rowsBetween(-post + 1, 0)),
            F.avg(value).over(w.rowsBetween(-post - pre + 1, -post)))


def centered_shift(daily: DataFrame, k: int = 5, width: int = 7, min_ratio: float = 1.3) -> DataFrame:
    """Centred rolling median against itself ``width`` days earlier: the largest shifts."""
    half = width // 2
    w = _series(daily).orderBy("date")
    around = w.rowsBetween(-half, half)
    roll = F.when(F.count("value").over(around) == width, F.percentile("value", F.lit(0.5)).over(around))
    rolled = daily.withColumn("roll", roll)
    rolled = rolled.withColumn("prev", F.lag("roll", width).over(w))
    scored = rolled.where("roll > 0 and prev > 0").withColumn(
        "abs_log_ratio", F.abs(F.ln(F.col("roll") / F.col("prev"))))
    return top_n(scored.where(F.col("abs_log_ratio") > math.log(min_ratio)), k, "abs_log_ratio", "date")


def autocorr(daily: DataFrame, lag: int) -> DataFrame:
    """Pearson correlation with the series ``lag`` days earlier; NULL for constant series."""
    pairs = daily.withColumn("y", F.lag("value", lag).over(_series(daily).orderBy("date"))).where("y is not null")
    r = F.try_divide(F.covar_pop("value", "y"), F.stddev_pop("value") * F.stddev_pop("y"))
    return pairs.groupBy(*_keys(daily)).agg(r.alias(f"autocorr_{lag}"))


def coef_variation(daily: DataFrame) -> DataFrame:
    return daily.groupBy(*_keys(daily)).agg(
        F.try_divide(F.stddev_samp("value"), F.avg("value")).alias("cv"))


def dow_mean(daily: DataFrame) -> DataFrame:
    """Mean per weekday (Monday 0), zero days included when the frame is gap-free."""
    return daily.groupBy(*_keys(daily), weekday().alias("dow")).agg(F.avg("value").alias("mean"))


def dow_index(daily: DataFrame) -> DataFrame:
    """Weekday mean over the overall mean."""
    per = daily.groupBy(*_keys(daily), weekday().alias("dow")).agg(
        F.sum("value").alias("s"), F.count("value").alias("n"))
    w = _series(per)
    overall = F.try_divide(F.sum("s").over(w), F.sum("n").over(w))
    return per.select(*_keys(daily), "dow", F.try_divide(F.try_divide(F.col("s"), F.col("n")), overall).alias("dow_index"))


def dow_hour_total(df: DataFrame, ts: Column) -> DataFrame:
    return (df.select(ts.alias("_ts")).groupBy(F.weekday("_ts").alias("dow"), F.hour("_ts").alias("hour"))
            .agg(F.count(F.lit(1)).alias("hits")))


def dow_hour_profile(df: DataFrame, ts: Column, last_days: int | None = None) -> DataFrame:
    """Mean hits per weekday and hour over the days that have that hour."""
    cells = df.select(F.to_date(ts).alias("date"), F.hour(ts).alias("hour"))
    if last_days is not None:
        cells = cells.where(F.col("date") >= cells.agg(F.date_sub(F.max("date"), last_days)).scalar())
    per = cells.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(weekday().alias("dow"), "hour").agg(F.avg("n").alias("mean_hits"))


def monthly_totals(df: DataFrame, day: str, scoped: Column) -> DataFrame:
    return df.groupBy(F.date_format(as_col(day), "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("total"), count_where(scoped).alias("scoped"))


def missing_days(daily: DataFrame) -> DataFrame:
    """Days of the active range (first to last positive day) that are zero or absent."""
    active = daily.where(F.col("value") > 0).select("date")
    return calendar_spine(active, "date").join(active, "date", "left_anti")


def series_stats(daily: DataFrame) -> DataFrame:
    return daily.groupBy(*_keys(daily)).agg(
        F.sum("value").alias("total"), F.count(F.lit(1)).alias("days"),
        count_where(F.col("value") > 0).alias("days_nonzero"),
        count_where(~(F.col("value") > 0)).alias("days_zero"),
        F.min("value").alias("min"), upper_median("value").alias("p50"), F.max("value").alias("max"))


def low_days(daily: DataFrame, floor: float = 100) -> DataFrame:
    """Is a population large enough for daily detection?"""
    return daily.groupBy(*_keys(daily)).agg(
        upper_median("value").alias("median"), F.min("value").alias("min"), F.max("value").alias("max"),
        count_where(F.col("value") < floor).alias("days_below"), count_where(F.col("value") == 0).alias("days_zero"),
        F.count(F.lit(1)).alias("days"))
