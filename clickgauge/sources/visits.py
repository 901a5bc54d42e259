"""Hits stored by visit: bucketed on the visit key, so that work at visit grain needs no shuffle of hits.

A KPI run groups hits by visit, joins them to qualifying visits and compares populations of visits, and each
of these shuffles the hits by the same key. ``VisitTable`` pays for that once, on the write: the table is
bucketed and sorted by the key, partitioned by day, and aggregates and joins on the key read whole buckets.

A bucket is one task, so a key that holds a large part of all hits must not sit in one. Keys of more than
``hot_rows`` hits in a write go to partitions of their own, which are read like any table: combined by key
before they are shuffled. A key that is hot in one window is treated as hot in all of them.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VISIT, HOT = "_visit", "_hot"
BUCKETS = 64
HOT_ROWS = 1_000_000
OVERWRITE_CONF = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class VisitTable:
    """A catalog table of hits with their visit key; hits without a key (NULL or '') are in no visit and not stored."""

    spark: SparkSession
    name: str
    day: str

    def write(self, df: DataFrame, visit: Column, path: str, start: str | None = None, buckets: int = BUCKETS, hot_rows: int = HOT_ROWS) -> None:
        """Creates the table below ``path``, or replaces its days from ``start`` on by those of ``df``.

        ``buckets`` holds for a new table; a later write may say the same number to write fewer files."""
        keyed = df.withColumn(VISIT, visit).where(F.col(VISIT) != "")
        sizes = keyed.groupBy(VISIT).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)  # one key in hot_rows hits at most
        marked = keyed.join(sizes.select(VISIT, F.lit(True).alias(HOT)), VISIT, "left").withColumn(HOT, F.coalesce(HOT, F.lit(False)))
        rest = [c for c in df.columns if c != self.day]
        # A task writes one bucket (a NULL leaves the hash of the key as it is); hits of hot keys go anywhere.
        salt = F.when(F.col(HOT), F.xxhash64(*rest))
        rows = marked.select(*rest, VISIT, HOT, self.day).repartition(buckets, VISIT, salt)
        if not self.spark.catalog.tableExists(self.name):
            (rows.write.format("parquet").option("path", path).partitionBy(HOT, self.day).bucketBy(buckets, VISIT).sortBy(VISIT).saveAsTable(self.name))
            return
        rows = rows.where(F.col(self.day).cast("string") >= start)
        kept = {tuple(r) for r in rows.select(F.col(HOT).cast("string"), F.col(self.day).cast("string")).distinct().collect()}  # partitions
        mode = self.spark.conf.get(OVERWRITE_CONF)  # inserts take no option for it
        self.spark.conf.set(OVERWRITE_CONF, "dynamic")
        try:
            rows.write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(OVERWRITE_CONF, mode)
        for (spec,) in self.spark.sql(f"show partitions {self.name}").collect():
            hot, day = (x.split("=", 1)[1] for x in spec.split("/"))
            if day >= start and (hot, day) not in kept:
                self.spark.sql(f"alter table {self.name} drop partition ({HOT}={hot}, {self.day}='{day}')")

    def hot_keys(self) -> DataFrame:
        return self.spark.table(self.name).where(HOT).select(VISIT).distinct()

    def _parts(self) -> list[DataFrame]:
        """Hits in whole buckets, and those of hot keys; no key is in both."""
        hits = self.spark.table(self.name)
        if hits.where(HOT).isEmpty():
            return [hits.where(~F.col(HOT)).drop(HOT)]
        hot = F.broadcast(self.hot_keys())  # bounded as the hot keys of a write are
        return [hits.where(~F.col(HOT)).join(hot, VISIT, "left_anti").drop(HOT),
                hits.where(HOT).unionByName(hits.where(~F.col(HOT)).join(hot, VISIT, "left_semi")).drop(HOT)]

    @staticmethod
    def _all(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def per_visit(self, *aggs: Column, by: tuple[str, ...] = ()) -> DataFrame:
        """Aggregates per visit, or per visit and further columns."""
        return self._all([p.groupBy(VISIT, *by).agg(*aggs) for p in self._parts()])

    def qualified(self, qualifies: Column) -> DataFrame:
        """All hits of every visit with at least one qualifying hit."""
        return self._all([p.join(p.where(qualifies).select(VISIT).distinct(), VISIT, "left_semi") for p in self._parts()])

    def overlap(self, a: Column, b: Column) -> DataFrame:
        """Sizes of two visit populations and of their overlap."""
        per = self.per_visit(F.coalesce(F.bool_or(a), F.lit(False)).alias("a"), F.coalesce(F.bool_or(b), F.lit(False)).alias("b"))
        n = {"visits_a": F.col("a"), "visits_b": F.col("b"), "both": F.col("a") & F.col("b"), "a_only": F.col("a") & ~F.col("b"), "b_only": F.col("b") & ~F.col("a")}
        out = per.agg(*[F.count(F.when(c, 1)).alias(k) for k, c in n.items()])
        return out.withColumn("share_b_retained", F.try_divide(F.col("both"), F.col("visits_b")))

    def daily_visits(self) -> DataFrame:
        """Distinct visits per day: two-level, the first of them within buckets."""
        return self.per_visit(F.count(F.lit(1)).alias("hits"), by=(self.day,)).groupBy(self.day).agg(
            F.count(F.lit(1)).alias("visits"), F.sum("hits").alias("hits"))
