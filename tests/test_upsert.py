"""Merging into months: other months' files stay, and a merge cut off anywhere is completed."""
from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from clickgauge.sources import sinks

SCHEMA = "anomaly_id string, month int, score double, status string, reconciled boolean"


def files(path):
    return {os.path.join(os.path.basename(r), f) for r, _, names in os.walk(path) for f in names if f.startswith("part-")}


def rows(spark, path):
    return sorted((r["anomaly_id"], r["month"], r["score"], r["status"]) for r in spark.read.parquet(path).collect())


@pytest.fixture
def table(spark, shared):
    path = f"{shared}/t"
    first = spark.createDataFrame([("a", 202401, 1.0, "closed", True), ("b", 202401, 1.0, "open", False), ("c", 202402, 1.0, "open", False), ("d", 202403, 1.0, "closed", True),
                                   ("n", None, 1.0, "open", False)], SCHEMA)
    sinks.upsert_preserve(first, path, by="month")
    return path


NEW = [("a", 202401, 2.0, "open", False), ("e", 202401, 2.0, "open", False), ("f", 202405, 2.0, "open", False), ("n", None, 2.0, "open", False)]
WANT = [("a", 202401, 2.0, "closed"), ("b", 202401, 1.0, "open"), ("c", 202402, 1.0, "open"), ("d", 202403, 1.0, "closed"), ("e", 202401, 2.0, "open"),
        ("f", 202405, 2.0, "open"), ("n", None, 2.0, "open")]


def test_only_months_with_incoming_rows_are_replaced(spark, table):
    before = files(table)
    for _ in range(2):  # a repeat changes nothing
        sinks.upsert_preserve(spark.createDataFrame(NEW, SCHEMA), table, by="month")
        assert rows(spark, table) == WANT
    kept = {f for f in before if f.startswith(("month=202402", "month=202403"))}
    assert kept <= files(table) and len(kept) == 2 and not (before - kept) & files(table)
    assert os.listdir(os.path.dirname(table)) == ["t"]


@pytest.mark.parametrize("after", range(8))
def test_a_merge_cut_off_after_any_rename_is_completed(spark, table, monkeypatch, after):
    """The write itself, then every single rename, may be the last thing a run does."""
    new, left = spark.createDataFrame(NEW, SCHEMA), [after]
    real = sinks._fs

    class Dying:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            def call(*args):
                if name == "rename":
                    if not left[0]:
                        raise RuntimeError("lost")
                    left[0] -= 1
                return getattr(self.fs, name)(*args)
            return call

    with monkeypatch.context() as broken:
        broken.setattr(sinks, "_fs", lambda s, p: (Dying(real(s, p)[0]), real(s, p)[1]))
        try:
            sinks.upsert_preserve(new, table, by="month")
        except RuntimeError:
            pass
    sinks.recover_partitions(spark, table)
    assert rows(spark, table) == WANT and os.listdir(os.path.dirname(table)) == ["t"]


def test_an_unfinished_set_is_dropped(spark, table):
    before = rows(spark, table)
    spark.createDataFrame(NEW, SCHEMA).write.partitionBy("month").parquet(f"{table}.parts-x")
    os.remove(f"{table}.parts-x/_SUCCESS")
    sinks.recover_partitions(spark, table)
    assert rows(spark, table) == before and os.listdir(os.path.dirname(table)) == ["t"]


def test_reads_only_touched_months(spark, table):
    """A later run over other months leaves those of an earlier one as analysts left them."""
    sinks.upsert_preserve(spark.createDataFrame([("z", 202403, 9.0, "open", False)], SCHEMA), table, by="month")
    assert ("d", 202403, 1.0, "closed") in rows(spark, table) and ("z", 202403, 9.0, "open") in rows(spark, table)
    assert spark.read.parquet(table).where(F.col("month") == 202401).count() == 2
