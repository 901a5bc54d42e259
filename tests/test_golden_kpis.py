"""Hand-computed KPI values on tiny frames."""
from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from clickgauge.plans import builder as B
from clickgauge.plans import registry as R

HIT_SCHEMA = ("hit_date date, post_event_list string, post_pagename string, post_page_event string, language string, "
              "mcvisid string, post_visid_high string, post_visid_low string, visit_num string")
HIT_REG = R.hit_basis_registry("t", R.HIT_BASIS_EVENT_IDS, R.HIT_BASIS_RATE_IDS,
                               ["overview", "enrol-now", "c", "d", "e"], R.HIT_BASIS_LANGUAGES)
VISIT_REG = R.visit_basis_registry(
    "t", R.VISIT_BASIS_EVENTS, R.FUNNEL_RATIOS, R.VISIT_BASIS_LANGUAGES, R.FUNNEL_EVENTS, "post_evar4",
    {"hd": "evar4_hd", "travel": "evar4_travel", "life": "evar4_life", "home": "evar4_home", "x": "evar4_x"})
D1, D2, D3 = date(2026, 2, 1), date(2026, 2, 2), date(2026, 2, 3)
V1, V2, V3 = date(2026, 7, 1), date(2026, 7, 2), date(2026, 7, 3)


def hit(day, who, high, low, num, events, page, lang, marker="0"):
    return (day, events, page, marker, lang, who, high, low, num)


def by_metric(wide):
    rows = wide.collect()
    return {m: {r["date"]: r[m] for r in rows} for m in wide.columns if m != "date"}


def build(spark, rows, schema=HIT_SCHEMA, reg=HIT_REG):
    return by_metric(B.kpi_wide(spark.createDataFrame(rows, schema), reg))


def test_registry_sizes():
    assert len(HIT_REG.series) == 42 and len(HIT_REG.scored) == 35
    assert len(VISIT_REG.series) == 53
    assert len(set(HIT_REG.metric_ids)) == 42 and len(set(VISIT_REG.metric_ids)) == 53


def test_hit_basis_values(spark):
    got = build(spark, [
        hit(D1, "A", "1", "1", "1", "20,500", "overview", "45"), hit(D1, "A", "1", "1", "1", "20", "overview", "45"),
        hit(D3, "B", "2", "2", "1", "10036", "enrol-now", "39"), hit(D3, "B", "2", "2", "1", "10036,20", "overview", "45"),
        hit(D3, "C", "3", "3", "1", "", "overview", "45")])
    want = {
        "hits_total": (2, 0, 3), "visits_total": (1, 0, 2), "visitors_total": (1, 0, 2), "event_20_count": (2, 0, 1),
        "event_500_count": (1, 0, 0), "event_10036_count": (0, 0, 2), "event_10036_rate": (0, 0, 2 / 3),
        "pagename_share_overview": (1, 0, 2 / 3), "pagename_share_enrol-now": (0, 0, 1 / 3), "language_share_39": (0, 0, 1 / 3),
        "page_views_total": (2, 0, 3), "pv_per_visit": (2, 0, 1.5), "pv_bucket_share_2": (1, 0, 0.5), "pv_bucket_share_1": (0, 0, 0.5)}
    for metric, expected in want.items():
        assert [got[metric][d] for d in (D1, D2, D3)] == pytest.approx(expected), metric
    assert set(got) == set(HIT_REG.metric_ids)


def test_column_order_is_registry_order(spark):
    df = spark.createDataFrame([hit(D1, "A", "1", "1", "1", "20", "overview", "45")], HIT_SCHEMA)
    assert B.kpi_wide(df, HIT_REG).columns == ["date", *HIT_REG.metric_ids]


@pytest.mark.parametrize("basis, views, zero_share, one_share", [("all_hits", 4, 0.0, 2 / 3), ("page_marker", 1, 2 / 3, 1 / 3)])
def test_page_view_basis(spark, basis, views, zero_share, one_share):
    rows = [hit(D1, "A", "1", "1", "1", "20", "overview", "45", "0"), hit(D1, "A", "1", "1", "1", "20", "overview", "45", "1"),
            hit(D1, "B", "2", "2", "1", "20", "overview", "45", "1"), hit(D1, "C", "3", "3", "1", "20", "overview", "45", "bogus")]
    got = build(spark, rows, reg=replace(HIT_REG, page_view_basis=basis))
    assert got["page_views_total"][D1] == views
    assert got["pv_bucket_share_0"][D1] == pytest.approx(zero_share)
    assert got["pv_bucket_share_1"][D1] == pytest.approx(one_share)
    assert sum(got[f"pv_bucket_share_{s}"][D1] for s in ("0", "1", "2", "3_5", "6plus")) == pytest.approx(1.0)


def test_ratio_and_zero_denominator(spark):
    series = (R.TOTALS[0], R.TOTALS[1], R.Ratio("hits_per_visit", "hits_total", "visits_total"))
    rows = [hit(D1, "h1", "h1", "l1", "1", "", "p", "45"), hit(D1, "h1", "h1", "l1", "1", "", "p", "45"),
            hit(D1, "h1", "h1", "l1", "2", "", "p", "45"), hit(D3, "h2", "h2", "l2", "1", "", "p", "45"), hit(D3, "h2", "h2", "l2", "1", "", "p", "45")]
    got = build(spark, rows, reg=R.Registry("r", series))
    assert [got["hits_per_visit"][d] for d in (D1, D2, D3)] == [1.5, 0.0, 2.0]


V_SCHEMA = ("hit_date date, post_event_list string, post_evar4 string, language string, post_visid_high string, "
            "post_visid_low string, visit_num string, visit_start_time_gmt string")
V_ROWS = [
    (V1, "228,103", "hd", "en", "h1", "l1", "1", "t1"), (V1, "228,229", "hd", "en", "h1", "l1", "1", "t1"),
    (V1, "228", "obscure-cat", "fr", "h1", "l1", "1", "t2"), (V1, "269,240", None, "en", "h2", "l2", "5", "t3"),
    (V3, None, "travel", "unknown", "h3", "l3", "1", "t4")]
# Hand-computed frames.
V_WANT = {
    "hits_total": (4, 0, 1), "visits_total": (3, 0, 1), "visitors_total": (2, 0, 1), "pel_228_quote_start": (2, 0, 0),
    "pel_229_quote_complete": (1, 0, 0), "pel_232_save_quote": (0, 0, 0), "pel_269_app_start": (1, 0, 0),
    "pel_240_app_confirm": (1, 0, 0), "pel_103_product_category_inst": (1, 0, 0),
    "funnel_quote_complete_over_quote_start": (0.5, 0, 0), "funnel_save_quote_over_quote_start": (0, 0, 0),
    "funnel_app_start_over_quote_start": (0.5, 0, 0), "funnel_app_confirm_over_app_start": (1, 0, 0),
    "funnel_app_confirm_over_quote_start": (0.5, 0, 0), "language_share_en": (0.75, 0, 0), "language_share_fr": (0.25, 0, 0),
    "language_share_unknown": (0, 0, 1), "pel_228_quote_start__evar4_hd": (1, 0, 0), "pel_228_quote_start__evar4_travel": (0, 0, 0),
    "pel_228_quote_start__evar4_other": (1, 0, 0), "pel_269_app_start__evar4_other": (1, 0, 0), "pel_240_app_confirm__evar4_other": (1, 0, 0),
    "pel_240_app_confirm__evar4_hd": (0, 0, 0)}


def test_visit_basis_values(spark):
    got = build(spark, V_ROWS, V_SCHEMA, VISIT_REG)
    assert set(got) == set(VISIT_REG.metric_ids) and set(got["hits_total"]) == {V1, V2, V3}
    for metric, expected in V_WANT.items():
        assert [got[metric][d] for d in (V1, V2, V3)] == pytest.approx(expected), metric


def test_null_parts_neither_collide_nor_invent_visitors(spark):
    rows = [(V1, None, None, "en", None, None, "9", "tx")] * 2 + [
        (V1, None, None, "en", "h", None, "1", "t"), (V1, None, None, "en", "h", "1", None, "t")]
    got = build(spark, rows, V_SCHEMA, VISIT_REG)
    assert got["visitors_total"][V1] == 2 and got["visits_total"][V1] == 3


def test_ratio_above_one_is_not_clamped(spark):
    rows = [(V1, "228", "hd", "en", "h1", "l1", "1", "t1"), (V1, "269", None, "en", "h2", "l2", "1", "t2"),
            (V1, "269,240", None, "en", "h3", "l3", "1", "t3")]
    got = build(spark, rows, V_SCHEMA, VISIT_REG)
    assert got["funnel_app_start_over_quote_start"][V1] == pytest.approx(2.0)
    assert got["funnel_app_confirm_over_quote_start"][V1] == pytest.approx(1.0)


def test_long_form(spark):
    long = B.kpi_long(B.kpi_wide(spark.createDataFrame(V_ROWS, V_SCHEMA), VISIT_REG))
    assert long.columns == ["date", "metric_id", "value"] and dict(long.dtypes)["value"] == "double"
    assert long.count() == 3 * len(VISIT_REG.series)


def test_more_than_one_word_of_flags(spark):
    """Visit flags beyond 60 series spill into a second word without mixing."""
    events = {str(1000 + i): f"m{i}" for i in range(75)}
    reg = R.visit_basis_registry("wide", events, [], [], [], "post_evar4", {})
    rows = [(V1, ",".join(list(events)[::2]), None, "en", "h", "l", "1", "t"), (V1, "1074,1074", None, "en", "h", "l", "2", "t")]
    got = build(spark, rows, V_SCHEMA, reg)
    assert [got[f"m{i}"][V1] for i in range(75)] == [1 if i % 2 == 0 and i != 74 else 2 if i == 74 else 0 for i in range(75)]


def test_bad_declarations(spark):
    df = spark.createDataFrame(V_ROWS, V_SCHEMA)
    with pytest.raises(ValueError, match="unknown event basis"):
        replace(VISIT_REG, event_basis="sessions")
    with pytest.raises(ValueError, match="unknown page view basis"):
        build(spark, [hit(D1, "A", "1", "1", "1", "20", "overview", "45")], reg=replace(HIT_REG, page_view_basis="scroll"))
    broken = R.Registry("r", (R.TOTALS[0], R.Ratio("x", "hits_total", "nope")))
    with pytest.raises(ValueError, match="unknown series"):
        B.kpi_wide(df, broken)
    with pytest.raises(ValueError, match="no such total"):
        R.Total("x", "sessions")


def test_empty_hits_give_an_empty_calendar(spark):
    assert B.kpi_wide(spark.createDataFrame([], HIT_SCHEMA), HIT_REG).count() == 0


def test_hot_key_counts_exactly(spark):
    """A third of all rows on one visit, visitor and day."""
    n = 30_000
    hot = F.col("id") % 3 == 0
    df = spark.range(n).select(
        F.when(hot, F.lit(D1)).otherwise(F.date_add(F.lit(D1), (F.col("id") % 3).cast("int"))).alias("hit_date"),
        F.lit("20,20,10036").alias("post_event_list"), F.lit("overview").alias("post_pagename"), F.lit("0").alias("post_page_event"),
        F.lit("45").alias("language"), F.when(hot, "hot").otherwise(F.col("id").cast("string")).alias("mcvisid"),
        F.when(hot, "hot").otherwise(F.col("id").cast("string")).alias("post_visid_high"), F.lit("1").alias("post_visid_low"), F.lit("1").alias("visit_num"))
    got = by_metric(B.kpi_wide(df, HIT_REG))
    assert [got["hits_total"][d] for d in (D1, D2, D3)] == [n // 3] * 3
    assert [got["visits_total"][d] for d in (D1, D2, D3)] == [1, n // 3, n // 3]
    assert [got["visitors_total"][d] for d in (D1, D2, D3)] == [1, n // 3, n // 3]
    assert got["event_20_count"][D1] == 2 * n // 3 and got["pv_bucket_share_6plus"][D1] == 1.0
