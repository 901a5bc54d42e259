"""Distinct counts over any period from stored day sketches, without reading hits again.

Distinct visitors of a month are no sum of days. A table of one HyperLogLog sketch per day, group and key
is a few kilobytes a day; sketches merge, so weeks, months and free windows are unions of its rows, and a day
that is processed anew replaces its own. Estimates have a standard error of ``1.04 / sqrt(2 ** LG_K)``, whatever
the number of days merged; hits are exact.
"""
from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_col
from ..functions.time import trunc_period
from ..sources import sinks

LG_K = 12
SUFFIX = "_sketch"


def relative_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Bound of the relative error at so many standard deviations."""
    return deviations * 1.04 / math.sqrt(2 ** lg_k)


def day_sketches(df: DataFrame, day: str | Column, keys: Mapping[str, Column], by: Mapping[str, Column] | None = None, lg_k: int = LG_K) -> DataFrame:
    """(date, groups, hits, a sketch per key); NULL keys are not counted, rows without a date are left out."""
    groups = [c.alias(n) for n, c in (by or {}).items()]
    return df.groupBy(F.to_date(as_col(day)).alias("date"), *groups).agg(
        F.count(F.lit(1)).alias("hits"), *[F.hll_sketch_agg(c.cast("string"), F.lit(lg_k)).alias(f"{n}{SUFFIX}") for n, c in keys.items()]).where("date is not null")


def refresh(sketches: DataFrame, path: str, start: str | None = None, days: Sequence[str] | None = None) -> None:
    """Stores the sketches: those from ``start`` on, or of the named days, take the place of what was there."""
    if days is not None:
        sinks.days_overwrite(sketches, path, "date", days)
    else:
        sinks.windowed_overwrite(sketches, path, "date", start or "")


def _merged(sketches: DataFrame, groups: Sequence[Column]) -> DataFrame:
    names = [c for c in sketches.columns if c.endswith(SUFFIX)]
    return sketches.groupBy(*groups).agg(
        F.sum("hits").alias("hits"), *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c.removesuffix(SUFFIX)) for c in names])


def rollup(sketches: DataFrame, period: str, by: Sequence[str] = ()) -> DataFrame:
    """Hits and distinct keys per period (daily, weekly, monthly, ...) and group; groups left out are merged too."""
    return _merged(sketches, [trunc_period("date", period).alias("period"), *[F.col(c) for c in by]])


def window(sketches: DataFrame, start: str, end: str, by: Sequence[str] = ()) -> DataFrame:
    """The same over the days from ``start`` to ``end``."""
    inside = sketches.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return _merged(inside, [F.col(c) for c in by])


def trailing(sketches: DataFrame, days: int) -> DataFrame:
    """Per day of the table, hits and distinct keys of the ``days`` days up to it: each day is repeated per window, as a sketch."""
    moved = sketches.withColumn("period", F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.date_add("date", i))))
    last = sketches.agg(F.max("date")).scalar()
    return _merged(moved.where(F.col("period") <= last), [F.col("period")])
