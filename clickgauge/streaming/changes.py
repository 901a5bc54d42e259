"""Which partitions have changed: a file-source stream over the source names the days that got new files.

A fixed overlap re-reads the last few days and never returns to older ones. Here a stream, run until it has
caught up, remembers every file it has seen in its checkpoint. Of the new files it reads nothing but the
day they lie in; each batch becomes a list of days, and the whole of those days is processed anew.

A batch that is delivered again, after a death between its work and its commit, has the number it had
before: the run of that number is found in the meta table and not repeated. A batch whose run died half-way is
run again over the same days. Files that vanish without a new one are not noticed.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.daily import Feed, Tables, changed_run
from ..plans.registry import Thresholds


def changed_days(batch: DataFrame, day: str) -> list[str]:
    """Days of a batch's rows, in order; rows without one are in no window."""
    rows = batch.select(F.substring(F.col(day).cast("string"), 1, 10).alias("d")).where("d is not null").distinct().collect()
    return sorted(r["d"] for r in rows)  # one row a day


def follow(spark: SparkSession, path: str, day: str, checkpoint: str, handle: Callable[[Sequence[str], int], None],
           files_per_batch: int | None = None) -> None:
    """Calls ``handle(days, batch number)`` for all files not seen before, until there are none left."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def each(batch: DataFrame, number: int) -> None:
        days = changed_days(batch, day)
        if days:
            handle(days, number)

    query = (reader.parquet(path).select(day).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def follow_source(spark: SparkSession, path: str, feed: Feed, tables: Tables, key: str | None, checkpoint: str, adapt: Callable[[DataFrame], DataFrame] = lambda df: df,
                  detected_at: str | None = None, th: Thresholds = Thresholds(), files_per_batch: int | None = None) -> list[str]:
    """Keeps the feed's tables up with the files below ``path``; returns the ids of the runs it published.

    Run ids are ``<feed>-<checkpoint's name>-<batch number>``, so a checkpoint belongs to one set of tables."""
    published = []

    def handle(days: Sequence[str], number: int) -> None:
        run_id = f"{feed.name}-{checkpoint.rstrip('/').rsplit('/', 1)[-1]}-{number}"
        if changed_run(adapt(spark.read.parquet(path)), feed, tables, days, run_id, key, detected_at, th):
            published.append(run_id)

    follow(spark, path, feed.day, checkpoint, handle, files_per_batch)
    return published
