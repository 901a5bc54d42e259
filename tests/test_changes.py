"""Days that got new files are processed once, wherever they lie; and merged sketches against exact counts."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickgauge.operators import rollups, volume
from clickgauge.plans import daily as D
from clickgauge.sources import adapters, sinks
from clickgauge.streaming import changes

from .test_sources import FEED, SF

AT = "2024-02-01T00:00:00Z"


@pytest.fixture(scope="module")
def source(spark):
    h = adapters.event_hits(spark, SF)
    return h.withColumn("post_event_list", F.col("raw_event_list")).select(*FEED.required)


def land(df, path):
    df.hint("rebalance", "hit_date").write.mode("append").partitionBy("hit_date").parquet(path)


def same(a, b):
    a = a.select(*b.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def check_tables(spark, tables, all_hits):
    """The tables equal those of one run over everything."""
    want = D.silver(D.bronze(all_hits, FEED), FEED, "secret")
    assert same(spark.read.parquet(tables.silver), want)
    assert same(spark.read.parquet(tables.gold), D.gold(want, FEED))
    assert same(spark.read.parquet(tables.dims), D.rules.dim_day_counts(want, "hit_date", FEED.registry.rule_dims))


def test_a_late_day_outside_the_overlap_is_processed_once(spark, shared, source, monkeypatch):
    path, seen, tables = f"{shared}/source", f"{shared}/seen", D.Tables.under(f"{shared}/t")
    middle = source.where("hit_date between date '2024-01-05' and date '2024-01-20'")
    late = (F.col("hit_date") == F.lit("2024-01-06").cast("date")) & (F.col("hit_id") % 2 == 0)
    land(middle.where(~late), path)

    def follow():
        return changes.follow_source(spark, path, FEED, tables, "secret", seen, detected_at=AT)

    assert follow() == ["demo-seen-0"]
    check_tables(spark, tables, middle.where(~late))
    assert follow() == [], "nothing new"
    land(middle.where(late), path)

    # A death half-way, then one between the run's last write and the commit of its batch.
    with monkeypatch.context() as broken:
        broken.setattr(D, "findings", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            follow()
    runs = []
    real = changes.changed_run
    with monkeypatch.context() as broken:
        def done_then_lost(frame, feed, t, days, run_id, *a, **k):
            runs.append((tuple(days), real(frame, feed, t, days, run_id, *a, **k)))
            raise RuntimeError("lost before the commit")
        broken.setattr(changes, "changed_run", done_then_lost)
        with pytest.raises(Exception, match="before the commit"):
            follow()
        with pytest.raises(Exception, match="before the commit"):
            follow()
    assert runs == [(("2024-01-06",), True), (("2024-01-06",), False)], "the batch comes again, its run does not"
    assert follow() == [] and follow() == []
    check_tables(spark, tables, middle)
    meta = [r["run_id"] for r in spark.read.parquet(tables.meta).collect()]
    assert sorted(meta) == ["demo-seen-0", "demo-seen-1"]

    # Days before the first and after the last known one: the calendar in between is filled.
    ends = source.where("hit_date in (date '2024-01-02', date '2024-01-24')")
    land(ends, path)
    assert follow() == ["demo-seen-2"]
    check_tables(spark, tables, middle.unionByName(ends))


def test_changed_days_need_no_other_partitions(spark, shared, source):
    """Files of untouched days stay as they are."""
    import os
    tables, frame = D.Tables.under(f"{shared}/t"), source.where("hit_date < date '2024-01-12'")
    assert D.changed_run(frame, FEED, tables, [f"2024-01-{d:02d}" for d in range(1, 12)], "a", "secret", AT)

    def files():
        return {os.path.join(r, f) for t in (tables.bronze, tables.silver, tables.gold, tables.dims) for r, _, names in os.walk(t) for f in names if f.startswith("part-")}

    before = files()
    fewer = frame.where("hit_date <> date '2024-01-04' or hit_id % 3 = 0")
    assert D.changed_run(fewer, FEED, tables, ["2024-01-04"], "b", "secret", AT)
    assert not D.changed_run(fewer, FEED, tables, ["2024-01-04"], "b", "secret", AT), "published before"
    touched = {os.path.basename(os.path.dirname(f)) for f in before ^ files()}
    assert touched == {"hit_date=2024-01-04", "date=2024-01-04"}
    check_tables(spark, tables, fewer)
    gone = frame.where("hit_date <> date '2024-01-04'")
    assert D.changed_run(gone, FEED, tables, ["2024-01-04"], "c", "secret", AT)
    check_tables(spark, tables, gone)


def test_days_overwrite(spark, shared):
    path = f"{shared}/d"
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3), (None, 4)], "d string, v int")
    df.write.partitionBy("d").parquet(path)
    new = spark.createDataFrame([("2024-01-03", 30), ("2024-01-02", 20)], "d string, v int")
    assert sinks.days_overwrite(new, path, "d", ["2024-01-03", "2024-01-01"]) == ["d=2024-01-01"]
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [2, 4, 30]


def test_rollups_stay_within_their_error_and_days_replace_their_sketch(spark, shared):
    hits = spark.range(300_000).repartition(4).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 75).cast("int")).alias("d"),
        F.when(F.col("id") % 10 > 0, F.xxhash64(F.col("id") % 70_000)).cast("string").alias("v"), (F.col("id") % 3 == 0).alias("clean"))
    path, keys, by = f"{shared}/s", {"visitors": F.col("v")}, {"clean": F.col("clean")}
    rollups.refresh(rollups.day_sketches(hits.where("clean"), "d", keys, by), path)
    for start in ("2024-01-01", "2024-02-10"):  # all days, then some of them again
        rollups.refresh(rollups.day_sketches(hits.where(F.col("d") >= F.lit(start).cast("date")), "d", keys, by), path, start)
    rollups.refresh(rollups.day_sketches(hits, "d", keys, by), path, days=["2024-01-07"])
    stored = spark.read.parquet(path)
    for period in ("daily", "weekly", "monthly"):
        exact = {r["period"]: r for r in volume.traffic_series(hits, F.col("d"), period, F.col("v"), F.col("v"), exact=True).collect()}
        got = {r["period"]: r for r in rollups.rollup(stored, period).collect()}
        assert set(got) == set(exact)
        for p, r in got.items():
            assert r["hits"] == exact[p]["hits"] and abs(r["visitors"] - exact[p]["visits"]) <= rollups.relative_error() * exact[p]["visits"]
    week = {r["period"]: r["visitors"] for r in rollups.trailing(stored, 7).collect()}
    day = max(week)
    exact = hits.where(F.col("d").between(F.date_sub(F.lit(day), 6), F.lit(day))).agg(F.count_distinct("v")).first()[0]
    assert len(week) == 75 and abs(week[day] - exact) <= rollups.relative_error() * exact
    per = {r["clean"]: r["visitors"] for r in rollups.window(stored, "2024-01-01", "2024-01-31", ["clean"]).collect()}
    assert set(per) == {True, False}
    assert "parquet" in rollups.rollup(stored, "weekly")._jdf.queryExecution().executedPlan().toString()


def test_no_hits_no_sketches(spark):
    none = spark.createDataFrame([], "d date, v string")
    assert rollups.rollup(rollups.day_sketches(none, "d", {"visitors": F.col("v")}), "weekly").count() == 0
    blank = spark.createDataFrame([(None, "a"), ("2024-01-01", None)], "d string, v string")
    row = rollups.rollup(rollups.day_sketches(blank, "d", {"visitors": F.col("v")}), "daily").first()
    assert row["hits"] == 1 and row["visitors"] == 0


