"""Counts at several grains from one pass over the hits.

A report that needs rows per host, per suite and per country, each with its shares, otherwise reads the
hits once for every number in it. Here the hits are counted once by all columns together, map-side combined,
and the grains are grouping sets over those counts. The result is written, so that whatever is derived from
it reads a small table.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import nonblank, pct
from ..sources.scratch import materialize


def joint_counts(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Rows per combination of the columns."""
    return df.groupBy(*[c.alias(n) for n, c in columns.items()]).agg(F.count(F.lit(1)).alias("n"))


def grain_counts(df: DataFrame, grains: Mapping[str, Column]) -> DataFrame:
    """(grain, value, n) for every value of every grain, NULL included, so that each grain sums up to all rows."""
    joint = joint_counts(df, {n: c.cast("string") for n, c in grains.items()})
    names = list(grains)
    sets = joint.groupingSets([[F.col(n)] for n in names], *names).agg(
        F.sum("n").alias("n"), *[F.grouping(n).alias(f"_not_{i}") for i, n in enumerate(names)])
    grain, value = F.lit(names[-1]), F.col(f"`{names[-1]}`")
    for i in range(len(names) - 2, -1, -1):
        here = F.col(f"_not_{i}") == 0
        grain, value = F.when(here, names[i]).otherwise(grain), F.when(here, F.col(f"`{names[i]}`")).otherwise(value)
    return sets.select(grain.alias("grain"), value.alias("value"), "n")


def stored_grains(df: DataFrame, grains: Mapping[str, Column]) -> DataFrame:
    return materialize(grain_counts(df, grains), "grains")


def values_of(counts: DataFrame, grain: str, name: str | None = None) -> DataFrame:
    """(value, n) of a grain's non-blank values."""
    return counts.where(F.col("grain") == grain).where(nonblank("value")).select(F.col("value").alias(name or grain), "n")


def shares_of(counts: DataFrame, grain: str, name: str | None = None, of_known: bool = False) -> DataFrame:
    """The same with ``pct`` of all rows, or of those that have a value."""
    mine = counts.where(F.col("grain") == grain)
    total = (mine.where(nonblank("value")) if of_known else mine).agg(F.sum("n")).scalar()
    return values_of(counts, grain, name).withColumn("pct", pct(F.col("n"), total))


def rows_of(counts: DataFrame, grain: str) -> Column:
    """All rows, as a scalar."""
    return counts.where(F.col("grain") == grain).agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()


def with_expected(counts: DataFrame, expected: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Counts with the expected value of each key beside them, in one aggregate; keys that only one side has are kept."""
    none = F.lit(None).cast(expected.schema[value].dataType)
    both = counts.select(*keys, "n", none.alias(value)).unionByName(expected.select(*keys, F.lit(0).cast("bigint").alias("n"), value))
    return both.groupBy(*keys).agg(F.sum("n").alias("n"), F.max(value).alias(value))
