"""Partition values of a table from its metadata: folder listings or the catalog, no file is opened.

Gates and windows ask for the latest day before anything is processed. On a table of many day folders
that is a question about names, not about rows. ``PartitionedTable`` answers it; frames and columns that
are no partitions fall back to an aggregate over the rows.

A partition counts when it holds a data file (names that begin with ``_`` or ``.`` and files of no bytes
don't). The NULL partition has no value and is never first or last. Values are compared in the column's own
type, text as text. Partition folders may be nested; only those above the column are listed.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import as_col
from .scan import scan_table
from .sinks import NULL_PARTITION, listing


@dataclass(frozen=True)
class PartitionedTable:
    """A table by name, or a folder of parquet files, whose partition values can be asked for."""

    spark: SparkSession
    source: str

    @cached_property
    def frame(self) -> DataFrame:
        return scan_table(self.spark, self.source)

    @cached_property
    def partition_columns(self) -> list[str]:
        """Partition columns, outermost first; a folder's are read off its first branch."""
        if "/" not in self.source:
            return [c.name for c in self.spark.catalog.listColumns(self.source) if c.isPartition]
        found, path = [], self.source
        while True:
            inner = [(name, is_dir) for name, is_dir, _ in listing(self.spark, path) if is_dir and "=" in name]
            if not inner:
                return found
            found.append(unquote(inner[0][0].split("=", 1)[0]))
            path = f"{path}/{inner[0][0]}"

    def values(self, col: str) -> set[str | None]:
        """Values of ``col`` as text over partitions that hold data, None for the NULL partition."""
        depth = self.partition_columns.index(col)
        if "/" not in self.source:
            rows = self.spark.sql(f"show partitions {self.source}").collect()  # names, one row a partition
            parts = [unquote(r[0].split("/")[depth].split("=", 1)[1]) for r in rows]
        else:
            level = [(self.source, None)]
            for at in range(depth + 1):
                level = [(f"{path}/{name}", name.split("=", 1)[1] if at == depth else value) for path, value in level
                         for name, is_dir, _ in listing(self.spark, path) if is_dir and "=" in name]
            by_value: dict[str, list[str]] = {}
            for path, value in level:
                by_value.setdefault(value, []).append(path)
            parts = [unquote(v) for v, paths in by_value.items() if any(self._has_data(p) for p in paths)]
        return {None if p == NULL_PARTITION else p for p in parts}

    def _has_data(self, path: str) -> bool:
        entries = listing(self.spark, path)
        return (any(size > 0 and not is_dir and name[0] not in "_." for name, is_dir, size in entries)
                or any(self._has_data(f"{path}/{name}") for name, is_dir, _ in entries if is_dir and name[0] not in "_."))

    def extremes(self, col: str) -> DataFrame:
        """One row (first, last) in the column's type."""
        kind = self.frame.schema[col].dataType.simpleString()
        known = [v for v in self.values(col) if v is not None]
        if kind == "string":
            ends = (min(known, key=str.encode), max(known, key=str.encode)) if known else (None, None)
            return self.spark.range(1).select(*[F.lit(v).cast(kind).alias(n) for v, n in zip(ends, ("first", "last"))])
        if not known:
            return self.spark.range(1).select(*[F.lit(None).cast(kind).alias(n) for n in ("first", "last")])
        typed = F.transform(F.array(*[F.lit(v) for v in sorted(known)]), lambda v: v.cast(kind))
        return self.spark.range(1).select(F.array_min(typed).alias("first"), F.array_max(typed).alias("last"))


Source = DataFrame | PartitionedTable


def as_frame(source: Source) -> DataFrame:
    return source.frame if isinstance(source, PartitionedTable) else source


def extremes(source: Source, col: str) -> DataFrame:
    """One row (first, last) of a column: from partition metadata where it is a partition, else from the rows."""
    if isinstance(source, PartitionedTable) and col in source.partition_columns:
        return source.extremes(col)
    c = as_col(col)
    return as_frame(source).agg(F.min(c).alias("first"), F.max(c).alias("last"))
