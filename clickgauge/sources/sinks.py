"""Idempotent writes on plain parquet.

Parquet has no replaceWhere and no MERGE, so window replacement is a dynamic partition
overwrite plus the removal of partitions that became empty, and whole tables are replaced by
renaming a finished version into place. Removal comes last: a run that dies half-way leaves
old rows, never a hole, and a re-run repairs it.
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def listing(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(name, is folder, bytes) of what lies in a folder; nothing for a folder that does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [(e.getPath().getName(), e.isDirectory(), e.getLen()) for e in fs.listStatus(p)]


def _partition_files(spark: SparkSession, path: str, col: str, start: str) -> dict[str, set[str]]:
    """Partition folder -> data file names, for partitions at or after ``start`` (metadata only)."""
    fs, root = _fs(spark, path)
    found = {}
    if fs.exists(root):
        for entry in fs.listStatus(root):
            name = entry.getPath().getName()
            value = name.split("=", 1)[1] if name.startswith(f"{col}=") else NULL_PARTITION
            if entry.isDirectory() and value != NULL_PARTITION and value >= start:
                found[name] = {f.getPath().getName() for f in fs.listStatus(entry.getPath())}
    return found


def windowed_overwrite(df: DataFrame, path: str, col: str, start: str, rebalance: bool = True) -> list[str]:
    """Replace every row with partition >= ``start`` by ``df``; earlier partitions stay.

    Rows are rebalanced on the partition first, so that a day is written by as many tasks as
    its size needs: adaptive execution merges small days and splits a hot one. Without it,
    every task writes a file per day.

    There is no upper bound: a narrower re-run also discards later partitions that the new
    data lacks. ISO dates compare as text; rows without a date are in no window and stay. Returns the partitions dropped as stale.
    """
    spark = df.sparkSession
    before = _partition_files(spark, path, col, start)
    window = df.where(F.col(col).cast("string") >= start)
    if rebalance:
        window = window.hint("rebalance", col)
    (window.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(col).parquet(path))
    after = _partition_files(spark, path, col, start)
    stale = sorted(name for name, files in before.items() if files & after.get(name, set()))
    fs, _ = _fs(spark, path)
    for name in stale:
        fs.delete(_fs(spark, f"{path}/{name}")[1], True)
    return stale


def days_overwrite(df: DataFrame, path: str, col: str, days: Sequence[str], rebalance: bool = True) -> list[str]:
    """Replace the partitions named by ``days`` by the rows of ``df``, whether they lie together or not; all others stay.

    Of two runs over the same days the later one counts. A day that has no rows any more loses its folder,
    last. Returns the partitions dropped."""
    spark = df.sparkSession
    names = {f"{col}={d}" for d in days}
    before = {n: f for n, f in _partition_files(spark, path, col, min(days)).items() if n in names} if days else {}
    rows = df.where(F.col(col).cast("string").isin(list(days)))
    if rebalance:
        rows = rows.hint("rebalance", col)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(path)
    after = _partition_files(spark, path, col, min(days)) if days else {}
    stale = sorted(n for n, files in before.items() if files & after.get(n, set()))
    for name in stale:
        fs, p = _fs(spark, f"{path}/{name}")
        fs.delete(p, True)
    return stale


def rundate_overwrite(df: DataFrame, path: str, run_date: str) -> None:
    """Replace one run's slice and keep the others."""
    (df.withColumn("run_date", F.lit(run_date).cast("date")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path))


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo a replacement that was cut off between its two renames.

    The new version is complete (it has its success marker) before anything is renamed, so it is taken;
    should there be none, the old one comes back. Leftovers of earlier replacements are removed."""
    fs, target = _fs(spark, path)
    parent, name = target.getParent(), target.getName()
    if not fs.exists(parent):
        return
    kinds = {"next": [], "old": []}
    for entry in fs.listStatus(parent):
        for kind, held in kinds.items():
            if entry.getPath().getName().startswith(f"{name}.{kind}-"):
                held.append(entry.getPath())
    if not fs.exists(target):
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        ready = [p for p in kinds["next"] if fs.exists(hadoop.Path(p, "_SUCCESS"))]
        for p in (ready or kinds["old"])[:1]:
            fs.rename(p, target)
    if fs.exists(target):
        for p in [*kinds["next"], *kinds["old"]]:
            if fs.exists(p):
                fs.delete(p, True)


def full_overwrite(df: DataFrame, path: str) -> None:
    """Rebuild the whole table; the schema may change, and ``df`` may read the table it replaces.

    The new version is written beside the old one and takes its place by two renames. A run that dies
    before them leaves the old table, one that dies between them is completed by :func:`recover`, which
    every write here begins with: no state loses rows."""
    spark = df.sparkSession
    tag = uuid.uuid4().hex
    df.write.parquet(f"{path}.next-{tag}")
    fs, target = _fs(spark, path)
    if fs.exists(target):
        fs.rename(target, _fs(spark, f"{path}.old-{tag}")[1])
    fs.rename(_fs(spark, f"{path}.next-{tag}")[1], target)
    recover(spark, path)


def append_meta(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Appended runs may have grown columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def merge_preserving(old: DataFrame, new: DataFrame, key: str, preserved: Sequence[str]) -> DataFrame:
    """Upsert as a full outer join: new values win, except for the analysts' columns."""
    cols = list(dict.fromkeys([*new.columns, *old.columns]))
    both = old.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    have_o, have_n = set(old.columns), set(new.columns)
    is_new = F.col(f"o.{key}").isNull()
    in_new = F.col(f"n.{key}").isNotNull()

    def merged(c):
        if c not in have_n:
            return F.col(f"o.{c}").alias(c)
        if c not in have_o:
            return F.col(f"n.{c}").alias(c)
        take_new = is_new if c in preserved else in_new
        return F.when(take_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)

    return both.select(*[merged(c) for c in cols])


def upsert_preserve(new: DataFrame, path: str, key: str = "anomaly_id",
                    preserved: Sequence[str] = ("status", "reconciled"), by: str | None = None) -> None:
    """Merge ``new`` into the table at ``path``; a repeat changes nothing.

    With ``by``, a column that the key determines (the month of a key made of a date, say), the table is
    partitioned by it and only partitions that hold incoming rows are read and replaced; all other files stay.
    Without, the whole table is rewritten."""
    spark = new.sparkSession
    recover(spark, path)
    if by is None:
        if path_exists(spark, path):
            new = merge_preserving(spark.read.parquet(path), new, key, preserved)
        full_overwrite(new, path)
        return
    recover_partitions(spark, path)
    if path_exists(spark, path):
        old = spark.read.schema(_with_kind(spark.read.parquet(path).schema, by, new)).parquet(path)
        touched = new.select(by).distinct()  # one row a partition
        old = old.join(F.broadcast(touched), old[by].eqNullSafe(touched[by]), "left_semi")
        new = merge_preserving(old, new, key, preserved)
    tag = uuid.uuid4().hex
    new.hint("rebalance", by).write.partitionBy(by).parquet(f"{path}{PARTS}{tag}")
    recover_partitions(spark, path)


PARTS, GONE = ".parts-", ".gone-"


def _with_kind(schema, col: str, like: DataFrame):
    """The schema with ``col`` of the type it has in ``like``: types of partition columns are only guessed."""
    kinds = [like.schema[col] if f.name == col else f for f in schema.fields]
    return type(schema)(kinds)


def recover_partitions(spark: SparkSession, path: str) -> None:
    """Put finished partitions in place, each by two renames; an unfinished set of them is dropped.

    A set is finished when it has its success marker. Cut off anywhere, a repeat goes on where it stopped:
    a partition that has been moved in is no longer in the set, one whose old version is set aside still is."""
    fs, target = _fs(spark, path)
    parent, name = target.getParent(), target.getName()
    for entry, is_dir, _ in sorted(listing(spark, str(parent))):
        if not entry.startswith(f"{name}{PARTS}"):
            continue
        made, gone = f"{parent}/{entry}", f"{parent}/{name}{GONE}{entry.removeprefix(name + PARTS)}"
        if path_exists(spark, f"{made}/_SUCCESS"):
            fs.mkdirs(target)
            fs.mkdirs(_fs(spark, gone)[1])
            for part in (n for n, is_dir, _ in listing(spark, made) if is_dir and "=" in n):
                place = _fs(spark, f"{path}/{part}")[1]
                if fs.exists(place):
                    fs.rename(place, _fs(spark, f"{gone}/{part}")[1])
                fs.rename(_fs(spark, f"{made}/{part}")[1], place)
        fs.delete(_fs(spark, made)[1], True)
    for entry, _, _ in listing(spark, str(parent)):
        if entry.startswith(f"{name}{GONE}"):
            fs.delete(_fs(spark, f"{parent}/{entry}")[1], True)


def slim_export(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns the detectors read, once each; feeds Spark detectors, no copy is made."""
    return df.select(*dict.fromkeys(columns))


def result_sinks(df: DataFrame, base: str) -> dict[str, str]:
    """Parquet, CSV and JSON copies of a result table."""
    paths = {fmt: f"{base}/{fmt}" for fmt in ("parquet", "csv", "json")}
    df.write.mode("overwrite").parquet(paths["parquet"])
    df.write.mode("overwrite").option("header", "true").csv(paths["csv"])
    df.write.mode("overwrite").json(paths["json"])
    return paths
