"""Properties of the physical plans: what must never appear, and what must be pruned."""
from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from clickgauge.catalog import REGISTERED
from clickgauge.catalog.kpis import HIT_REG, VISIT_REG
from clickgauge.plans import registry as R
from clickgauge.plans.builder import kpi_wide
from clickgauge.sources import adapters

SF = "/root/testdata/sf0.001"
NEVER = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert not [w for w in NEVER if w in text]


@pytest.mark.parametrize("reg", [HIT_REG, VISIT_REG], ids=["hit", "visit"])
def test_kpi_scans_read_only_needed_columns(spark, shared, reg):
    path = f"{shared}/hits"
    adapters.event_hits(spark, SF).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    text = plan(kpi_wide(spark.read.parquet(path), reg))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    needed = {reg.date_col, *reg.visit_key, *reg.visitor_key, reg.event_col, reg.page_marker, *[s.dim for s in reg.of(R.Share, R.Cell)]}
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas
    for s in schemas:
        assert {c.split(":")[0] for c in s.split(",")} <= needed
    assert len(schemas) == 3, "one scan each for hit, visit and visitor grain; none for the calendar"


def test_hit_grain_shuffles_days_not_hits(spark):
    """Partial aggregation by day sits below the first exchange."""
    df = entry.queries()["daily_hits"](spark, SF)
    text = plan(df)
    assert text.count("HashAggregate") >= 2 and text.count("Exchange hashpartitioning") == 1


def test_top_per_group_trims_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(entry.queries()["top_per_group"](spark, SF))


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["top_values"](spark, SF))


def test_adapter_scan_is_pruned(spark):
    text = plan(entry.queries()["daily_hits"](spark, SF))
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz>", text)


@pytest.mark.parametrize(("name", "most"), [("scope_tiers", 0), ("tier_coverage", 0), ("unclassified_hosts", 0), ("suite_inventory", 0), ("run_rules", 0), ("fid_dims", 1), ("fid_events", 1)])
def test_reports_of_many_counts_read_the_hits_once(spark, name, most):
    """What they derive comes from counts that one pass has written; the plan left reads the hits at most once more."""
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    text = plan(entry.queries()[name](spark, SF))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(re.findall(r"FileScan parquet .*Location: [^\n]*(?:events|orders|pages)\.parquet", text)) <= most


def test_all_grains_come_from_one_scan(spark):
    from pyspark.sql import functions as F
    from clickgauge.operators import grains
    h = adapters.event_hits(spark, SF)
    cols = {"host": F.col("language"), "suite": F.col("rsid"), "country": F.col("geo_country")}
    text = plan(grains.grain_counts(h, cols))
    assert text.count("FileScan") == 1 and text.count("Expand") == 1
    got = {(r["grain"], r["value"]): r["n"] for r in grains.grain_counts(h, cols).collect()}
    want = {(g, r[0]): r[1] for g, c in cols.items() for r in h.groupBy(c).count().collect()}
    assert got == want
