"""Write cadence of a table, from any log with a commit timestamp."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .series import upper_median

MICROS_PER_HOUR = 3_600_000_000


def commit_cadence(log: DataFrame, ts: str, op: str, slice_hours: float = 1.0,
                   exact: bool = False) -> DataFrame:
    """Commits per operation, with the median, shortest and longest gap in hours.

    One operation may own most of a long log, so its rows are never sorted in one task: gaps
    are taken inside fixed time slices, and the gap between two slices comes from their edges
    (one row per operation and slice). The median is a bounded sketch; ``exact`` holds the
    distinct gaps of an operation and is for short logs.
    """
    rows = log.select(F.col(op).alias("op"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"))
    rows = rows.withColumn("slice", F.floor(F.col("us") / int(slice_hours * MICROS_PER_HOUR)))
    inside = Window.partitionBy("op", "slice").orderBy("us")
    gaps = rows.select("op", (F.col("us") - F.lag("us").over(inside)).alias("gap"))
    edges = rows.groupBy("op", "slice").agg(F.min("us").alias("lo"), F.max("us").alias("hi"),
                                            F.count(F.lit(1)).alias("n"))
    across = Window.partitionBy("op").orderBy("slice")
    bridges = edges.select("op", (F.col("lo") - F.lag("hi").over(across)).alias("gap"))
    hours = gaps.unionByName(bridges).select("op", (F.col("gap") / MICROS_PER_HOUR).alias("hours"))
    median = upper_median("hours") if exact else F.percentile_approx("hours", 0.5)
    stats = hours.where("hours is not null").groupBy("op").agg(
        median.alias("median_gap_hours"), F.min("hours").alias("min_gap_hours"),
        F.max("hours").alias("max_gap_hours"))
    return edges.groupBy("op").agg(F.sum("n").alias("commits")).join(stats, "op", "left")
