"""Visit qualification, population overlap, calendar gaps and parity between KPI tables."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_col, count_where, flag
from .calendar import calendar_spine


def combine_single_rows(*frames: DataFrame) -> DataFrame:
    """Columns of several one-row frames side by side, without a cross join."""
    cols = [c for f in frames for c in f.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in cols])


_IS_VISIT = "_visit <> ''"


def qualified_visits(df: DataFrame, visit: Column, qualifies: Column) -> DataFrame:
    """All hits of every visit with at least one qualifying hit.

    Qualifying keys are reduced to a distinct set first. Spark broadcasts that set when its
    measured size allows and otherwise sort-merges, splitting skewed hit partitions. Hits without
    any part of a key (a NULL or empty one) belong to no visit: they neither qualify nor are kept.
    """
    keyed = df.withColumn("_visit", visit)
    keys = keyed.where(qualifies).where(_IS_VISIT).select("_visit").distinct()
    return keyed.join(keys, "_visit", "left_semi").drop("_visit")


def flag_qualified(df: DataFrame, visit: Column, qualifies: Column, out: str = "qualified") -> DataFrame:
    """As :func:`qualified_visits`, but marks the hits instead of dropping the others."""
    keyed = df.withColumn("_visit", visit)
    keys = keyed.where(qualifies).where(_IS_VISIT).select("_visit").distinct().withColumn(out, F.lit(True))
    return keyed.join(keys, "_visit", "left").withColumn(out, F.coalesce(out, F.lit(False))).drop("_visit")


def visit_overlap(df: DataFrame, visit: Column, a: Column, b: Column) -> DataFrame:
    """Sizes of two visit populations and of their overlap, from one group-by on the key."""
    per = (df.select(visit.alias("_visit"), flag(a).alias("a"), flag(b).alias("b"))
           .where("_visit is not null").groupBy("_visit").agg(F.max("a").alias("a"), F.max("b").alias("b")))
    in_a, in_b = F.col("a") == 1, F.col("b") == 1
    n = per.agg(count_where(in_a).alias("visits_a"), count_where(in_b).alias("visits_b"),
                count_where(in_a & in_b).alias("both"), count_where(in_a & ~in_b).alias("a_only"),
                count_where(in_b & ~in_a).alias("b_only"))
    return n.withColumn("share_b_retained", F.try_divide(F.col("both"), F.col("visits_b")))


def gap_days(df: DataFrame, day: str) -> DataFrame:
    """Interior days without a single row."""
    present = df.select(F.to_date(as_col(day)).alias("date")).distinct()
    return calendar_spine(present, "date").join(present, "date", "left_anti")


def zero_days(long: DataFrame) -> DataFrame:
    """Days on which every series is zero."""
    return (long.groupBy("date").agg(F.max(F.abs("value")).alias("peak"))
            .where("peak = 0").select("date"))


def zero_fill_trap(long: DataFrame, hits: DataFrame, day: str) -> DataFrame:
    """All-zero KPI days, each marked synthetic (no source rows) or genuine."""
    present = hits.select(F.to_date(as_col(day)).alias("date")).distinct().withColumn("_seen", F.lit(True))
    marked = zero_days(long).join(present, "date", "left")
    return marked.select("date", F.col("_seen").isNull().alias("is_synthetic"))


def mask_synthetic(long: DataFrame, hits: DataFrame, day: str) -> DataFrame:
    """Drop days the calendar invented, for detectors that must not learn from them."""
    present = hits.select(F.to_date(as_col(day)).alias("date")).distinct()
    return long.join(present, "date", "left_semi")


def kpi_parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two KPI tables: unmatched (date, metric) cells and the largest absolute difference."""
    left = a.select("date", "metric_id", F.col("value").alias("value_a"), F.lit(True).alias("in_a"))
    right = b.select("date", "metric_id", F.col("value").alias("value_b"), F.lit(True).alias("in_b"))
    both = left.join(right, ["date", "metric_id"], "full_outer")
    matched = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    return both.agg(
        F.count(F.lit(1)).alias("cells"), count_where(~matched).alias("unmatched"),
        F.max(F.when(matched, F.abs(F.col("value_a") - F.col("value_b")))).alias("max_abs_diff"))


def inst_presence(instances: DataFrame, presence: DataFrame) -> DataFrame:
    """Token occurrences beside hit presence per id, keeping ids of either side."""
    return instances.join(presence, "event_id", "full_outer")


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, label: str = "label") -> DataFrame:
    """Left join to a small dimension; broadcast only if Spark measures it as small."""
    side = lookup.select(F.col(lookup.columns[0]).alias(key), F.col(lookup.columns[1]).alias(label))
    return df.join(side, key, "left")
