"""Gap-free calendars and zero filling."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import as_col


def calendar_spine(df: DataFrame, day: str | Column, out: str = "date") -> DataFrame:
    """Every day from the first to the last day present; reads only the day column."""
    bounds = df.agg(F.min(as_col(day)).alias("lo"), F.max(as_col(day)).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(out))


def join_calendar(spine: DataFrame, *frames: DataFrame, on: str = "date") -> DataFrame:
    """Left join per-day aggregates onto the calendar."""
    for frame in frames:
        spine = spine.join(frame, on, "left")
    return spine


def zero_fill(df: DataFrame, *cols: str) -> DataFrame:
    return df.fillna(0, subset=list(cols))


def stack_on_calendar(spine: DataFrame, frames: list[DataFrame], counts: list[str],
                      on: str = "date") -> DataFrame:
    """Merge per-day counts onto the calendar with one aggregate instead of one join each.

    Every frame has one row per day at most and lacks some of the counts, so the sum per day
    is the merge; what no frame has is zero.
    """
    stacked = spine.select(on)
    for f in frames:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return stacked.groupBy(on).agg(*[F.coalesce(F.sum(f"`{c}`"), F.lit(0)).cast("long").alias(c) for c in counts])


def stack_days(frames: list[DataFrame], counts: list[str], on: str = "date") -> DataFrame:
    """Merge per-day counts, each in one frame only, into a row per day that any frame has."""
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return stacked.groupBy(on).agg(*[F.coalesce(F.sum(f"`{c}`"), F.lit(0)).cast("long").alias(c) for c in counts])


def fill_days(daily: DataFrame, counts: list[str], on: str = "date", first_day: str | None = None) -> DataFrame:
    """Zero rows for the days missing between the rows of ``daily`` (one per day), and back to ``first_day``.

    The window runs over one row per calendar day, which is all it ever holds. Without rows, none are made."""
    by_day = Window.partitionBy(F.lit(1)).orderBy(on)
    last = F.coalesce(F.date_sub(F.lead(on).over(by_day), 1), F.col(on))
    first = F.col(on)
    if first_day is not None:
        begins = F.lag(on).over(by_day).isNull()
        first = F.when(begins, F.least(F.lit(first_day).cast("date"), F.col(on))).otherwise(F.col(on))
    days = daily.withColumn("_first", first).withColumn("_last", last).withColumn(
        "_day", F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))))
    return days.select(F.col("_day").alias(on), *[
        F.when(F.col("_day") == F.col(on), F.col(f"`{c}`")).otherwise(F.lit(0)).cast("long").alias(c) for c in counts])
