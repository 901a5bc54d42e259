"""Detectors, rules, injection and scoring on planted data."""
from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from clickgauge.operators import detect as D
from clickgauge.operators import evaluate as E
from clickgauge.operators import inject as N
from clickgauge.operators import rules as RU
from clickgauge.operators import series as S
from clickgauge.plans import builder as B
from clickgauge.plans import registry as R

VOLUME = R.Registry("v", (R.TOTALS[0],))


def noise(i, salt=""):
    """Deterministic pseudo-noise in [-1, 1)."""
    h = F.conv(F.substring(F.md5(F.concat(i.cast("string"), F.lit(salt))), 1, 6), 16, 10).cast("double")
    return h / 8388608.0 - 1.0


def series(spark, n, value, metric="hits_total"):
    i = F.col("id")
    return spark.range(n).select(F.date_add(F.lit(date(2026, 1, 1)), i.cast("int")).alias("date"), F.lit(metric).alias("metric_id"),
                                 value(i).cast("double").alias("value"))


def weekly(i):
    return F.when(F.weekday(F.date_add(F.lit(date(2026, 1, 1)), i.cast("int"))) >= 5, 550.0).otherwise(1000.0)


def flagged(df):
    return {str(r["date"]) for r in df.collect()}


def test_planted_spike_is_flagged(spark):
    long = series(spark, 120, lambda i: F.round(weekly(i) * (1 + 0.05 * noise(i)) * F.when(i == 60, 2.5).otherwise(1.0)))
    found = D.detect_univariate(long, VOLUME)
    assert str(date(2026, 1, 1) + timedelta(60)) in flagged(found)
    row = found.where(F.col("date") == date(2026, 1, 1) + timedelta(60)).first()
    assert row["severity"] in ("major", "critical") and row["anomaly_id"] == "hits_total:2026-03-02:univariate"
    assert row["observed"] > 2 * row["expected"] > 0
    assert D.ANOMALY_COLUMNS == found.columns


def test_short_and_constant_series_are_skipped(spark):
    assert D.detect_univariate(series(spark, 20, lambda i: i * 100), VOLUME).count() == 0
    assert D.detect_univariate(series(spark, 60, lambda i: F.lit(7)), VOLUME).count() == 0


def test_warm_up_is_not_scored(spark):
    long = series(spark, 100, lambda i: F.when(i == 10, 99999).otherwise(100 + i % 5))
    assert str(date(2026, 1, 11)) not in flagged(D.detect_univariate(long, VOLUME))


def test_level_shift(spark):
    long = series(spark, 150, lambda i: weekly(i) * (1 + 0.06 * noise(i)) * F.when(i >= 100, 1.9).otherwise(1.0))
    days = flagged(D.detect_level_shift(long, VOLUME))
    assert days & {str(date(2026, 1, 1) + timedelta(k)) for k in range(101, 114)}
    quiet = series(spark, 150, lambda i: weekly(i) * (1 + 0.06 * noise(i)))
    assert D.detect_level_shift(quiet, VOLUME).count() == 0


def test_zero_volume_rule(spark):
    long = series(spark, 3, lambda i: F.when(i == 1, 0).otherwise(1000))
    row = RU.rule_zero_volume(long).collect()
    assert [(str(r["date"]), r["severity"], r["class"]) for r in row] == [("2026-01-02", "critical", "operational")]


def test_event_coverage_rule(spark):
    reg = R.hit_basis_registry("r", R.HIT_BASIS_EVENT_IDS, [], [], [])
    long = None
    for e in R.HIT_BASIS_EVENT_IDS:
        part = series(spark, 20, lambda i, e=e: F.when((i == 5) & F.lit(e == "10036"), 0).when((i % 2 == 0) & F.lit(e == "500"), 0).otherwise(5), f"event_{e}_count")
        long = part if long is None else long.unionByName(part)
    rows = RU.rule_event_coverage(long, reg).collect()
    assert [(r["metric_id"], str(r["date"])) for r in rows] == [("event_10036_count", "2026-01-06")]


def dims(spark, n, value):
    i = F.col("id")
    return spark.range(n * 100).select(F.date_add(F.lit(date(2026, 1, 1)), (i / 100).cast("int")).alias("d"), value((i / 100).cast("int"), i % 100).alias("v"))


def test_blank_jump_rule(spark):
    hits = dims(spark, 30, lambda day, j: F.when((day == 20) & (j < 30), F.lit(None)).when((day == 5) & (j < 50), "").otherwise("x"))
    rows = RU.rule_blank_jump(RU.dim_day_counts(hits, "d", ["v"])).collect()
    assert [(str(r["date"]), r["metric_id"], r["observed"]) for r in rows] == [("2026-01-21", "v_blank_rate", 0.3)]


def test_new_value_rule_counts_present_days(spark):
    """The index skips days without hits: 28 present days must have passed, not calendar days."""
    def value(day, j):
        return F.when((day == 35) & (j < 5), "new").when((day == 36) & (j < 1), "rare").otherwise("old")
    hits = dims(spark, 40, value).where("d <> date '2026-01-03'")
    rows = RU.rule_new_value(RU.dim_day_counts(hits, "d", ["v"])).collect()
    assert [(str(r["date"]), r["segment"], r["observed"]) for r in rows] == [("2026-02-05", "new", 0.05)]


def test_unknown_rule_and_method(spark):
    with pytest.raises(ValueError, match="unknown rule kinds"):
        RU.run_rules(series(spark, 3, lambda i: i), None, VOLUME, kinds=["freshness"])
    with pytest.raises(ValueError, match="unknown method"):
        D.multivariate_scores(series(spark, 3, lambda i: i), VOLUME, "forest")


def test_autocorr_of_a_constant_is_null(spark):
    assert S.autocorr(series(spark, 30, lambda i: F.lit(4)), 7).first()["autocorr_7"] is None


def test_upper_median(spark):
    df = spark.createDataFrame([(v,) for v in (4.0, 1.0, 3.0, 2.0)], "v double")
    assert df.agg(S.upper_median("v").alias("m")).first()["m"] == 3.0


def bell(i, salt):
    """Sum of four uniform draws: bell-shaped, standard deviation near 1.15."""
    return noise(i, salt) + noise(i, salt + "b") + noise(i, salt + "c") + noise(i, salt + "d")


def hits(spark, n_days=156, per_day=320):
    """Synthetic hits: weekday shape with daily noise, an always-on event, a few pages."""
    start = F.lit(date(2026, 2, 1))
    i, day = F.col("id"), F.datediff("hit_date", start)
    df = spark.range(n_days * per_day).select(
        i.alias("hit_id"), F.date_add(start, (i / per_day).cast("int")).alias("hit_date"), (i % per_day).alias("j"))
    volume = F.when(F.weekday("hit_date") >= 5, 130).otherwise(250) * (1 + 0.04 * bell(day, "n"))
    page = F.pmod(F.xxhash64("hit_id"), F.lit(10))
    who = F.pmod(F.xxhash64("hit_id", F.lit(1)), F.lit(100_000)).cast("string")
    return df.where(F.col("j") < volume).select(
        "hit_id", "hit_date", F.when(page == 0, "20,10036").otherwise("10036").alias("post_event_list"),
        F.when(page < 3, "site:overview").when(page < 6, "site:plans").otherwise("site:other").alias("post_pagename"),
        F.lit("45").alias("language"), F.lit("0").alias("post_page_event"), who.alias("mcvisid"),
        F.lit("1").alias("post_visid_high"), who.alias("post_visid_low"), F.lit("1").alias("visit_num"))


def test_five_scenarios_are_recalled(spark, shared):
    from clickgauge.sources.scratch import materialize
    reg = R.hit_basis_registry("e2e", ["20", "10036"], ["10036"], ["site:overview", "site:plans"], ["45"], rule_dims=("post_pagename", "language"))
    scenarios = N.default_scenarios("post_pagename", "site:overview", "10036")
    df = hits(spark)
    for sc in scenarios:
        df = N.inject(df, sc)
    df = materialize(df, "injected")
    long = materialize(B.kpi_long(B.kpi_wide(df, reg)), "gold")
    found = D.anomaly_union([D.detect_univariate(long, reg), D.detect_level_shift(long, reg), D.detect_multivariate(long, reg),
                             RU.run_rules(long, df, reg)], "now")
    found = materialize(found, "found")
    manifest = N.manifest(spark, scenarios)
    recall = {r["scenario"]: r for r in E.score_recall(found, manifest).collect()}
    assert len(recall) == 5 and all(r["detected"] for r in recall.values()), recall
    # A contrast of adjacent windows answers for four more weeks; those echoes are not counted.
    echo = manifest.withColumn("date_end", F.date_add("date_end", 28))
    fp = {r["class"]: r for r in E.score_fp(found, D.fp_denominators(long, reg), E.excluded_days(echo, None)).collect()}
    assert fp["operational"]["flagged_fp"] == 0 and fp["business"]["rate"] <= 0.03, fp


def test_injected_counts_are_exact(spark):
    df = hits(spark, 60).select("hit_id", "hit_date", "post_pagename", "post_event_list")
    sc = N.Scenario("s", "spike", "hits", "2026-03-10", "2026-03-10", 2.5)
    n = df.where(sc.inside("hit_date")).count()
    after = N.inject(df, sc)
    assert after.where(sc.inside("hit_date")).count() == n + round(n * 1.5)
    assert after.count() == after.select("hit_id").distinct().count(), "appended rows carry fresh ids"
    mix = N.Scenario("m", "dim_mix_shift", "share", "2026-03-01", "2026-03-03", 0.2, dim="post_pagename", value="forced")
    n = df.where(mix.inside("hit_date")).count()
    assert N.inject(df, mix).where("post_pagename = 'forced'").count() == round(n * 0.2)
    with pytest.raises(ValueError):
        N.inject(df, N.Scenario("x", "teleport", "hits", "2026-03-01", "2026-03-01", 1.0))


def test_hash_rank_is_a_permutation(spark):
    got = N.with_hash_rank(spark.range(5000).withColumnRenamed("id", "k"), "k").agg(
        F.min("_rank"), F.max("_rank"), F.count_distinct("_rank"), F.max("_total")).first()
    assert tuple(got) == (1, 5000, 5000, 5000)


def test_unknown_scenario_type_fails(spark):
    bad = N.manifest(spark, [N.Scenario("x", "teleport", "hits", "2026-03-01", "2026-03-01", 1.0)])
    with pytest.raises(Exception, match="unknown scenario type"):
        bad.select(E.relevant_metrics(F.col("type"), F.col("scope"))).collect()


def test_anomaly_row_covers_every_scored_series(spark):
    """The registered query scores the whole registry against its baselines, not one count of hits."""
    from clickgauge.catalog import REGISTERED
    from clickgauge.catalog.detection import ORDER_REG
    sf = "/root/testdata/sf0.01"
    got, whole = (REGISTERED[q].build(spark, sf).select(*D.ANOMALY_COLUMNS).collect() for q in ("anomaly_row", "detect_univariate"))
    assert len({r["metric_id"] for r in got}) > 1 and {r["metric_id"] for r in got} <= {s.metric_id for s in ORDER_REG.scored}
    assert sorted(map(str, got)) == sorted(map(str, whole))
    assert REGISTERED["anomaly_row"].sql == REGISTERED["detect_univariate"].sql


def test_recall_range_join_scores_every_scenario(spark):
    """Scenarios that nothing found are in the result, too: one row each, with what found them and how late."""
    from clickgauge.catalog import REGISTERED
    from clickgauge.catalog.detection import SCENARIOS
    got = REGISTERED["recall_range_join"].build(spark, "/root/testdata/sf0.001")
    assert set(got.columns) == {"scenario", "type", "detected", "detectors", "delay_days", "flags_in_window"}
    assert sorted(r["scenario"] for r in got.collect()) == sorted(s.anomaly_id for s in SCENARIOS)
