"""Scans, sinks, incremental control and the daily run."""
from __future__ import annotations


import pytest
from pyspark.sql import functions as F

from clickgauge.functions.predicates import Scope
from clickgauge.operators import dq
from clickgauge.plans import daily as D
from clickgauge.plans import registry as R
from clickgauge.sources import adapters, scan, scratch, sinks
from clickgauge.streaming import incremental as I

SF = "/root/testdata/sf0.001"


def days(spark, path):
    return {str(r["d"]): r["n"] for r in spark.read.parquet(path).groupBy("d").agg(F.sum("n").alias("n")).collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "d string, n long").withColumn("d", F.col("d").cast("date"))


def test_windowed_overwrite_replaces_and_drops(spark, shared):
    path = f"{shared}/t"
    first = frame(spark, [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3), ("2024-01-04", 4)])
    assert sinks.windowed_overwrite(first, path, "d", "2024-01-01") == []
    second = frame(spark, [("2024-01-01", 99), ("2024-01-02", 20), ("2024-01-04", 40)])
    assert sinks.windowed_overwrite(second, path, "d", "2024-01-02") == ["d=2024-01-03"]
    assert days(spark, path) == {"2024-01-01": 1, "2024-01-02": 20, "2024-01-04": 40}
    sinks.windowed_overwrite(second, path, "d", "2024-01-02")
    assert days(spark, path) == {"2024-01-01": 1, "2024-01-02": 20, "2024-01-04": 40}


def test_windowed_overwrite_has_no_upper_bound(spark, shared):
    path = f"{shared}/t"
    sinks.windowed_overwrite(frame(spark, [("2024-01-01", 1), ("2024-01-05", 5)]), path, "d", "2024-01-01")
    sinks.windowed_overwrite(frame(spark, [("2024-01-02", 2)]), path, "d", "2024-01-02")
    assert days(spark, path) == {"2024-01-01": 1, "2024-01-02": 2}


def test_upsert_keeps_analyst_columns(spark, shared):
    path = f"{shared}/a"
    schema = "anomaly_id string, score double, status string, reconciled boolean"
    sinks.upsert_preserve(spark.createDataFrame([("a", 1.0, "open", False), ("b", 1.0, "open", False)], schema), path)
    spark.read.parquet(path).withColumn("status", F.lit("closed")).write.mode("overwrite").parquet(f"{shared}/edited")
    sinks.full_overwrite(spark.read.parquet(f"{shared}/edited"), path)
    new = spark.createDataFrame([("b", 2.0, "open", False, "r2"), ("c", 3.0, "open", False, "r2")], schema + ", run_id string")
    sinks.upsert_preserve(new, path)
    got = {r["anomaly_id"]: (r["score"], r["status"], r["run_id"]) for r in spark.read.parquet(path).collect()}
    assert got == {"a": (1.0, "closed", None), "b": (2.0, "closed", "r2"), "c": (3.0, "open", "r2")}


def test_scratch_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert scratch.shared_dir(spark) == named
    df = scratch.materialize(spark.range(5), "five")
    assert df.count() == 5 and scratch.shared_dir(spark) in df.inputFiles()[0]
    scratch.release(spark)
    assert not sinks.path_exists(spark, df.inputFiles()[0])


def test_a_cluster_without_a_named_folder_is_refused():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_dir(Session())


def test_contract_and_policy(spark):
    with pytest.raises(scan.SchemaContractError, match="nope"):
        scan.schema_contract(spark.range(1), ["id", "nope"])
    assert scan.column_policy(["a", "b", "c", "s"], ["b", "a"], ["c", "b", "x", "s"], ["s"]) == ["b", "a", "c"]


@pytest.mark.parametrize("src, tgt, mode, new", [
    ("2024-01-02", "2024-01-01", "incremental", True), ("2024-01-01", "2024-01-01", "incremental", False),
    ("2024-01-01", "2024-01-01", "backfill", True), (None, "2024-01-01", "incremental", False), ("2024-01-01", None, "incremental", True)])
def test_freshness_gate(spark, src, tgt, mode, new):
    def t(v):
        return frame(spark, [(v, 1)] if v else [])
    assert I.freshness_gate(t(src), t(tgt), "d", mode).first()["new_data"] is new


def test_gate_without_a_target_table(spark):
    assert I.freshness_gate(frame(spark, [("2024-01-01", 1)]), None, "d").first()["new_data"] is True
    assert I.ingest_window(None, "d", 3, "2024-01-01", spark=spark).first()["start"].isoformat() == "2024-01-01"


def test_gates_raise(spark):
    empty = spark.range(0)
    with pytest.raises(dq.DataQualityError):
        dq.enforce(dq.dq_nonempty(empty))
    half = spark.createDataFrame([(None,), ("1",)], "e string")
    with pytest.raises(dq.DataQualityError):
        dq.enforce(dq.dq_nonnull_frac(half, "e", 0.95))
    dq.enforce(dq.dq_nonnull_frac(half, "e", 0.5))
    assert dq.dq_key_cardinality(half.where("e is not null"), "e").first()["verdict"] == "WARN"


FEED = D.Feed(
    name="demo", registry=R.hit_basis_registry("demo", ["20", "228", "10036"], ["10036"], ["site:view:0"], ["45"],
                                               rule_dims=("post_pagename", "language")),
    scope=Scope(include=("%plans.example.com%", "%regimes.example.net%"), exclude=("%uat.%",), login_hosts=("%login.example.com%",), suites=("suite_a", "suite_b")),
    required=("hit_id", "hit_date", "date_time", "hit_time_gmt", "post_event_list", "mcvisid", "post_visid_high", "post_visid_low",
              "visit_num", "post_page_event", "language", "post_pagename", "page_url", "post_page_url", "exclude_hit", "hit_source"),
    sensitive=("campaign",), check_eligibility=True, nonnull_floor=0.9)


@pytest.fixture
def source(spark):
    h = adapters.event_hits(spark, SF)
    return h.withColumn("post_event_list", F.col("raw_event_list"))


def test_daily_run_end_to_end(spark, shared, source):
    tables = D.Tables.under(f"{shared}/run")
    early = source.where("hit_date <= date '2024-01-20'")
    assert D.daily_run(early, FEED, tables, "r1", "secret")
    assert not D.daily_run(early, FEED, tables, "r2", "secret"), "nothing new: the gate stops the run"
    assert D.daily_run(source, FEED, tables, "r3", "secret")

    hits = spark.read.parquet(tables.silver)
    cond, report = FEED.scope.condition(source)
    assert report == {"active": ["suite", "url"], "missing": []}
    from clickgauge.functions.predicates import hit_eligible
    assert hits.count() == source.where(cond).where(hit_eligible()).count()
    assert hits.where("mcvisid is not null and not mcvisid rlike '^[0-9a-f]{64}$'").count() == 0
    assert hits.where("post_event_list like '%=%'").count() == 0 and "page_url" not in hits.columns
    long = spark.read.parquet(tables.gold).select("date", "metric_id", "value")
    one_go = D.gold(D.silver(D.bronze(source, FEED), FEED, "secret"), FEED)
    assert long.exceptAll(one_go).count() == 0 and one_go.exceptAll(long).count() == 0
    meta = {r["run_id"]: r for r in spark.read.parquet(tables.meta).collect()}
    assert set(meta) == {"r1", "r3"} and meta["r3"]["denominators"]["multivariate"] == meta["r3"]["n_days"]
    assert spark.read.parquet(tables.anomalies).groupBy("anomaly_id").count().where("count > 1").count() == 0


STAGES = ["schema_contract", "silver_gates", "gold", "findings", "run_meta"]


@pytest.mark.parametrize("stage", STAGES)
def test_a_run_that_died_is_completed_by_the_next(spark, shared, source, monkeypatch, stage):
    """The same tables as without the failure, with a day that arrived meanwhile, late rows and a gap at the edge."""
    at = "2024-01-31T00:00:00Z"
    early = source.where("hit_date <= date '2024-01-12'")
    later = source.where("hit_date <= date '2024-01-13' or hit_date >= date '2024-01-16'")

    def died(*args, **kwargs):
        raise RuntimeError("lost")

    tables = D.Tables.under(f"{shared}/run")
    assert D.daily_run(early, FEED, tables, "r1", "secret", detected_at=at)
    with monkeypatch.context() as broken:
        broken.setattr(D.scan if stage == "schema_contract" else D, stage, died)
        with pytest.raises(RuntimeError, match="lost"):
            D.daily_run(source.where("hit_date <= date '2024-01-13'"), FEED, tables, "r2", "secret", detected_at=at)
    assert D.daily_run(later, FEED, tables, "r3", "secret", detected_at=at)
    want = D.gold(D.silver(D.bronze(later, FEED), FEED, "secret"), FEED)
    got = spark.read.parquet(tables.gold).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert {r["run_id"] for r in spark.read.parquet(tables.meta).collect()} == {"r1", "r3"}
    hits = spark.read.parquet(tables.silver)
    counts = D.rules.dim_day_counts(hits, "hit_date", FEED.registry.rule_dims)
    kept = spark.read.parquet(tables.dims).select(*counts.columns)
    assert kept.exceptAll(counts).count() == 0 and counts.exceptAll(kept).count() == 0


def test_visit_basis_feed_end_to_end(spark, shared, source):
    """Eligibility, host language, visit-distinct events and cells; an injected dip is found."""
    from clickgauge.operators import evaluate
    reg = R.visit_basis_registry("visits", R.VISIT_BASIS_EVENTS, R.FUNNEL_RATIOS, ["en", "fr", "unknown"], ["228", "269"], "post_evar4", {"hd": "evar4_hd"})
    feed = D.Feed(name="visits", registry=reg, scope=FEED.scope, required=(*FEED.required, "post_evar4", "visit_start_time_gmt"),
                  check_eligibility=True, nonnull_floor=0.9, lang_hosts=(("plans.example.com", "en"), ("regimes.example.net", "fr")))
    hit = F.col("hit_date") == F.lit("2024-01-24").cast("date")
    fewer = source.where(~hit | (F.col("hit_id") % 12 == 0))
    tables = D.Tables.under(f"{shared}/visits")
    assert D.daily_run(fewer, feed, tables, "r1", "secret", mode="backfill", detected_at="2024-02-01T00:00:00Z")
    long, hits = spark.read.parquet(tables.gold), spark.read.parquet(tables.silver)
    assert {r[0] for r in hits.select("language").distinct().collect()} <= {"en", "fr", "unknown"} and "page_url" not in hits.columns
    total = long.where("metric_id = 'visits_total'").agg(F.sum("value")).first()[0]
    assert total == hits.where(reg.visit_expr().isNotNull()).select("hit_date", reg.visit_expr()).distinct().count()
    truth = spark.createDataFrame([("a", "dip", None, (None, None, None), "2024-01-24", "2024-01-24", 0.9)],
                                  evaluate.MANIFEST_SCHEMA.replace(" date,", " string,")).withColumns(
        {c: F.col(c).cast("date") for c in ("date_start", "date_end")})
    assert evaluate.score_recall(spark.read.parquet(tables.anomalies), truth).first()["detected"]
    assert spark.read.parquet(tables.anomalies).select("detected_at").distinct().first()[0] == "2024-02-01T00:00:00Z"
    report = {r["report"]: r["verdict"] for r in D.verification(spark, tables, feed).where("report <> 'events' and report <> 'language_share'").collect()}
    assert set(report) == {"volume", "conform", "gold_shape", "zero_fill", "pseudonym", "ratios"} and report["gold_shape"] == "PASS"


def test_backfill_needs_its_hosts(spark, shared, source):
    from dataclasses import replace
    feed = replace(FEED, required_hosts=("nowhere.example.org",))
    with pytest.raises(dq.DataQualityError, match="nowhere"):
        D.daily_run(source, feed, D.Tables.under(f"{shared}/run"), "r1", "secret", mode="backfill")


def test_synthetic_days_can_be_left_out(spark, source):
    from dataclasses import replace
    gap = D.silver(D.bronze(source.where("hit_date < date '2024-01-10' or hit_date > date '2024-01-12'"), FEED), FEED, None)
    long = D.gold(gap, FEED)
    silent = D.findings(long, gap, FEED, "t").where("detector = 'zero_volume'").count()
    assert silent == 3
    assert D.findings(long, gap, replace(FEED, skip_synthetic=True), "t").where("detector = 'zero_volume'").count() == 0


def test_window_keeps_rows_without_a_date(spark, shared):
    path = f"{shared}/n"
    spark.createDataFrame([("2024-01-01", 1), ("2024-01-05", 2), (None, 3)], "d string, v int").write.partitionBy("d").parquet(path)
    assert sinks.windowed_overwrite(spark.createDataFrame([("2024-01-04", 9)], "d string, v int"), path, "d", "2024-01-03") == ["d=2024-01-05"]
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 3, 9]


@pytest.mark.parametrize("died", ["before", "between"])
def test_a_replacement_cut_off_loses_nothing(spark, shared, died):
    path = f"{shared}/t"
    old = spark.createDataFrame([("a", 1, "closed")], "anomaly_id string, x int, status string")
    sinks.full_overwrite(old, path)
    old.withColumn("x", F.lit(2)).write.parquet(f"{path}.next-1")
    if died == "between":
        import os
        os.rename(path, f"{path}.old-1")
    new = spark.createDataFrame([("a", 5, "open"), ("b", 6, "open")], "anomaly_id string, x int, status string")
    for _ in range(2):  # a repeat changes nothing
        sinks.upsert_preserve(new, path)
        assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 5, "closed"), ("b", 6, "open")]
    import os
    assert [n for n in os.listdir(shared) if n.startswith("t.")] == []


def test_privacy_choice_does_not_move_kpis(spark, source):
    raw = D.bronze(source, FEED)
    hashed, clear = (D.gold(D.silver(raw, FEED, k), FEED) for k in ("secret", None))
    assert hashed.exceptAll(clear).count() == 0


def test_scope_reports_missing_columns(spark):
    cond, report = Scope(include=("%a%",), suites=("s",)).condition(spark.range(1))
    assert report == {"active": [], "missing": ["suite", "url"]}


def test_partition_predicate_prunes(spark, shared):
    path = f"{shared}/p"
    frame(spark, [("2024-01-01", 1), ("2024-01-02", 2)]).write.partitionBy("d").parquet(path)
    df = spark.read.parquet(path)
    plan = df.where(I.partition_pred(df, "d", "2024-01-02"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "DataFilters: []" in plan
    with_text = df.withColumn("d", F.col("d").cast("string"))
    assert with_text.where(I.partition_pred(with_text, "d", "2024-01-02", "2024-01-02")).count() == 1


def test_trailing_window_reads_only_its_partitions(spark, shared):
    path = f"{shared}/p"
    frame(spark, [(f"2024-01-{i:02d}", i) for i in range(1, 11)]).write.partitionBy("d").parquet(path)
    df = spark.read.parquet(path)
    late = I.in_window(df, "d", I.ingest_window(df, "d", 2, "2024-01-01"))
    assert late.count() == 3
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan.split("PartitionFilters:")[1].split("]")[0]
