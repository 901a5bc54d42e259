"""Quality of the feed itself: duplicates, skew, lateness, eligibility codes."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_col, pct
from .census import top_n


def crosstab_pct(df: DataFrame, a: str, b: str, k: int | None = None) -> DataFrame:
    """Joint distribution of two code columns, measured before any filter: every pair, or the ``k`` largest."""
    n = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n")).scalar()
    shown = n if k is None else top_n(n, k, "n", a, b)
    return shown.withColumn("pct", pct(F.col("n"), total))


def clock_skew(df: DataFrame, local: Column, epoch: str | Column, interpolate: bool = False) -> DataFrame:
    """Exact p5, p50 and p95 of local wall clock minus epoch, in seconds: skews that occur, or ``interpolate``d ones.

    Skews are counted first, so the state is bounded by distinct skews.
    """
    skew = df.select((F.unix_timestamp(local) - as_col(epoch).try_cast("bigint")).alias("s")).where("s is not null")
    ranks = {"p5": 0.05, "p50": 0.5, "p95": 0.95}
    if interpolate:
        counted = skew.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
        return counted.agg(*[F.percentile("s", q, F.col("n")).alias(p) for p, q in ranks.items()])
    return skew.agg(*[F.expr(f"percentile_disc({q}) within group (order by s)").alias(p) for p, q in ranks.items()])


def second_latest_day(df: DataFrame, day: str) -> Column:
    """The latest complete day: the one before the last, as a scalar subquery."""
    days = df.select(F.to_date(as_col(day)).alias("d")).where("d is not null").distinct()
    return days.orderBy(F.desc("d")).limit(2).agg(F.min("d")).scalar()


def duplicate_rate(df: DataFrame, day: str, key: Sequence[str]) -> DataFrame:
    """Rows against distinct keys on the latest complete day."""
    one = df.where(F.to_date(as_col(day)) == second_latest_day(df, day))
    per_key = one.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    n = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_keys"))
    return n.withColumn("dup_pct", pct(F.col("rows") - F.col("distinct_keys"), F.col("rows"), 4))


def late_arrival(df: DataFrame, loaded: str | Column, happened: str | Column) -> DataFrame:
    """p50, p95 and p99 of load day minus event day."""
    lag = df.select(F.datediff(as_col(loaded), as_col(happened)).alias("lag"))
    p = lag.agg(F.percentile_approx("lag", [0.5, 0.95, 0.99]).alias("p"))
    return p.select(*[F.col("p")[i].alias(name) for i, name in enumerate(("p50", "p95", "p99"))])
