"""Where intermediate tables go: the shared folder the cluster names, never a local disk."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_local_dirs: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without one gets a folder of its own."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/clickgauge/{label}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in paths:
        folder = jvm.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Removes every intermediate table of this session; none of its results may still be read."""
    _remove(spark, _written.pop(spark.sparkContext.applicationId, []))


def discard(df: DataFrame) -> None:
    """Removes one intermediate table whose readers are done."""
    written = _written.get(df.sparkSession.sparkContext.applicationId, [])
    path = getattr(df, "_scratch_path", None)
    if path in written:
        written.remove(path)
        _remove(df.sparkSession, [path])


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables materialized within go at the end, but for those passed through the function it yields."""
    written = _written.setdefault(spark.sparkContext.applicationId, [])
    before, kept = set(written), set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._scratch_path)
        return df

    try:
        yield keep
    finally:
        spent = [p for p in written if p not in before and p not in kept]
        written[:] = [p for p in written if p not in spent]
        _remove(spark, spent)


@contextmanager
def _shuffle_files_go(spark: SparkSession) -> Iterator[None]:
    """Writes within leave no shuffle files: their tables are complete, so nobody reads the files again."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once and read back: cuts lineage durably, and later reads survive lost executors."""
    path = scratch_path(df.sparkSession, label)
    _written.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    with _shuffle_files_go(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out
