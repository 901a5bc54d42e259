"""Incremental control: watermarks, the freshness gate and the trailing re-processing window.

Late hits are handled by re-reading the last few days on every run, so each step is a bounded
batch. Every function returns a plan; nothing is collected to decide. Sources are frames or
``PartitionedTable``s; the latter answer from partition metadata, without a scan.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_col
from ..operators.joins import combine_single_rows
from ..sources.partitions import Source, extremes

MODES = ("incremental", "backfill")


def watermark(df: Source | None, col: str, out: str = "watermark") -> DataFrame | None:
    """Latest partition as 'YYYY-MM-DD' in one row (NULL when empty); None for no table."""
    if df is None:
        return None
    return extremes(df, col).select(F.substring(F.col("last").cast("string"), 1, 10).alias(out))


def freshness_gate(source: Source | None, target: Source | None, col: str,
                   mode: str = "incremental") -> DataFrame:
    """One row: is there anything new to process?

    A back-fill always runs; so does a first load. An empty source never does.
    """
    if source is None and target is None:
        raise ValueError("freshness_gate needs a source or a target table")
    sides = {"source_watermark": source, "target_watermark": target}
    marks = combine_single_rows(*[watermark(df, col, out) for out, df in sides.items() if df is not None])
    for out in sides:
        if out not in marks.columns:
            marks = marks.withColumn(out, F.lit(None).cast("string"))
    src, tgt = F.col("source_watermark"), F.col("target_watermark")
    new = (F.when(F.lit(mode == "backfill"), True).when(tgt.isNull(), True)
           .when(src.isNull(), False).otherwise(src > tgt))
    return marks.select(src, tgt, new.alias("new_data"))


def ingest_window(target: Source | None, col: str, overlap_days: int, start_date: str,
                  mode: str = "incremental", spark=None) -> DataFrame:
    """One row holding the first day to (re)process."""
    first = F.lit(start_date).cast("date")
    if target is None:
        return spark.range(1).select(first.alias("start"))
    last = extremes(target, col).select(F.col("last").cast("date").alias("last"))
    if mode == "backfill":
        return last.select(first.alias("start"))
    return last.select(F.coalesce(F.date_sub("last", overlap_days), first).alias("start"))


def partition_pred(df: DataFrame, col: str, start: str, end: str | None = None) -> Column:
    """Window predicate with literals of the partition's own type, so files are pruned."""
    kind = dict(df.dtypes)[col]

    def literal(v):
        return F.lit(v).cast(kind) if kind in ("date", "timestamp", "timestamp_ntz") else F.lit(v)

    pred = as_col(col) >= literal(start)
    return pred if end is None else pred & (as_col(col) <= literal(end))


def dry_run_window(df: DataFrame, month: str | None, start: str, end: str) -> DataFrame:
    """One-row (start, end); a 'yyyy-MM' month overrides both."""
    first = F.lit(f"{month}-01").cast("date") if month else F.lit(start).cast("date")
    last = F.last_day(first) if month else F.lit(end).cast("date")
    return df.sparkSession.range(1).select(first.alias("start"), last.alias("end"))


def in_window(df: DataFrame, col: str, window: DataFrame) -> DataFrame:
    """Rows at or after the window's ``start``: a scalar subquery, evaluated once at run time
    and usable for partition and file pruning."""
    return df.where(as_col(col) >= window.select("start").scalar())
