"""Column expressions on edge values."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickgauge.functions import events as E
from clickgauge.functions import keys as K
from clickgauge.functions import predicates as P
from clickgauge.functions import text as T
from clickgauge.functions import time as TM
from clickgauge.functions import url as U
from clickgauge.functions.privacy import pseudonymize_enabled

from .conftest import values


def col(spark, items, expr, name="c"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, {name} string")
    return values(df.select("i", expr.alias("v")).orderBy("i"), "v")


def test_event_list_normalize(spark):
    got = col(spark, ["10036=1,20=1,500", "  10036 = 1 , 20 ", None, "10036,20", ""], E.event_list_normalize("c"))
    assert got == ["10036,20,500", "10036,20", None, "10036,20", ""]


def test_event_tokens_and_presence(spark):
    got = col(spark, ["1=2.5,1=x, 3 ,,", None], E.event_tokens("c"))
    assert [(t["id"], t["value"]) for t in got[0]] == [("1", 2.5), ("1", None), ("3", None)] and got[1] == []
    assert col(spark, ["1=2.5,1=x, 3 ,,", None], E.event_presence("c")) == [["1", "3"], []]
    assert col(spark, ["1,11,1", None], E.event_count("c", "1")) == [2, 0]
    assert col(spark, ["11,2", "1", None], E.event_contains("c", "1")) == [False, True, False]


def test_event_label_ranges(spark):
    df = spark.createDataFrame([(i,) for i in ("20", "100", "199", "200", "10000", "10099", "10100", "junk", "510")], "id string")
    lookup = spark.createDataFrame([("20", "Campaign View")], "event_id string, label string")
    got = {r["id"]: r["label"] for r in E.with_event_label(df, "id", lookup, pending=("510",)).collect()}
    assert got["20"] == "Campaign View" and got["100"] == "Instance of eVar1" and got["199"] == "Instance of eVar100"
    assert got["10000"] == "Instance of eVar101" and got["10099"] == "Instance of eVar200" and got["510"] == E.PENDING_LABEL
    assert got["200"] == got["10100"] == got["junk"] == E.NO_LABEL


def test_url_coalesce(spark):
    rows = [("https://www.Example.com/A", "x", "x", "x"), ("  ", "https://two.example/B", "x", "x"),
            (None, " ", "https://three.example/C", "x"), ("", None, "", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    got = values(df.select(U.url_coalesce("a", "b", "c", "d").alias("u")), "u")
    assert got == ["https://www.example.com/a", "https://two.example/b", "https://three.example/c", ""]
    raw = values(df.select(U.url_coalesce_raw("a", "b").alias("u")), "u")
    assert raw == ["https://www.example.com/a", "  ", " ", ""]


@pytest.mark.parametrize("url, host, path", [
    ("https://a.example.com/x/y?q=1#f", "a.example.com", "/x/y"), ("http://a.example.com", "a.example.com", "/"),
    ("a.example.com/", "a.example.com", "/"), ("https://a.example.com?x=/y", "a.example.com", "/")])
def test_host_and_path(spark, url, host, path):
    hp = U.host_path("c")
    assert col(spark, [url], U.url_host(hp)) == [host] and col(spark, [url], U.url_path(hp)) == [path]


def test_path_generalize_ids(spark):
    uuid = "123e4567-e89b-12d3-a456-426614174000"
    got = col(spark, [f"/a/{uuid}/b/12345/c/{'ab' * 8}", "/a/123/x1234", "/1234/5678", "/"], U.path_generalize_ids("c"))
    assert got == ["/a/{id}/b/{id}/c/{id}", "/a/123/x1234", "/{id}/{id}", "/"]


def test_path_prefix(spark):
    assert col(spark, ["/a/b/c/d", "/a", "/", "<blank>", "/a//c"], U.path_prefix("c", 2)) == ["/a/b", "/a", "/", "/", "/a"]


def test_url_strip_and_elide(spark):
    assert col(spark, ["HTTPS://www.A.com/x//?q#f", " a.com "], U.url_strip("c")) == ["a.com/x", "a.com"]
    assert col(spark, ["https://a/b?x=1&y&z=2", "https://a/b", None], U.href_elide("c")) == ["https://a/b?x=<v>&y&z=<v>", "https://a/b", None]
    assert col(spark, ["https%3a%2f%2fa%2fb%3fx%3d1%26"], U.pct_decode4("c")) == ["https://a/b?x=1%26"]


def test_language_is_read_from_the_raw_href(spark):
    """Decoding first would expose the inner locale of a redirect target."""
    df = spark.createDataFrame([("https://id.example/?goto=%3Fui_locales%3Den-CA&ui_locales=fr", "", "")], "h string, n string, p string")
    ways = U.lang_four_ways("h", "n", "p", href_hosts={}, names={}, page_patterns={})
    assert values(df.select(ways["href_param"].alias("v")), "v") == ["fr"]
    decoded = U.lang_four_ways(U.pct_decode4(F.lower("h")), "n", "p", href_hosts={}, names={}, page_patterns={})
    assert values(df.select(decoded["href_param"].alias("v")), "v") == ["en"]


def test_timestamps_are_ansi_safe(spark):
    df = spark.createDataFrame([(1, "2026-07-01 10:00:00", "1751364000"), (2, "not-a-timestamp", "1751364000"), (3, None, None)], "i int, d string, e string")
    got = values(df.select("i", F.date_format(TM.event_ts_safe("d", "e"), "yyyy-MM-dd HH:mm:ss").alias("v")).orderBy("i"), "v")
    assert got == ["2026-07-01 10:00:00", "2025-07-01 10:00:00", None]
    chain = TM.event_ts_chain("d", "e", F.lit("2026-01-02").cast("date"))
    assert values(df.select("i", F.date_format(chain, "yyyy-MM-dd HH").alias("v")).orderBy("i"), "v")[2] == "2026-01-02 00"


def test_month_window(spark):
    df = spark.createDataFrame([("2026-07-08",)], "d string")
    assert str(df.select(TM.month_window_start(F.col("d").cast("date"), 13).alias("v")).first()["v"]) == "2025-06-01"


def test_hit_eligible(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(
        [("0", "1"), ("14", "1"), ("4", "1"), ("0", "5"), ("0", "2"), (None, "1"), ("junk", None)])], "i int, exclude_hit string, hit_source string")
    assert values(df.select("i", P.hit_eligible().alias("v")).orderBy("i"), "v") == [True, False, False, False, True, True, True]


def test_like_any_never_null(spark):
    m = P.like_any("c", ["%A%"])
    assert col(spark, ["xax", None, "b"], m) == [True, False, False]
    assert col(spark, ["xax", None, "b"], ~m) == [False, True, True]


def test_dated_baseline_scope(spark):
    rows = [(1, "https://old.example/trip", "2024-03-11"), (2, "https://old.example/trip", "2024-03-12"),
            (3, "https://old.example/a.uat.b", "2024-01-01"), (4, "https://www.example.com/x", "2026-07-01")]
    df = spark.createDataFrame(rows, "i int, u string, d string")
    cond = P.scope_baseline_dated(F.col("u"), ["%www.example.com%"], ["%.uat.%"], ["%old.example%"], "2024-03-11", F.col("d").cast("date"))
    assert values(df.select("i", cond.alias("v")).orderBy("i"), "v") == [True, False, False, True]


def test_key_forms(spark):
    df = spark.createDataFrame([(1, "h", None, "1"), (2, "h", "1", None), (3, None, None, None)], "i int, a string, b string, c string")
    plain = values(df.select("i", K.key_plain("a", "b", "c").alias("v")).orderBy("i"), "v")
    safe = values(df.select("i", K.key_null_safe("a", "b", "c").alias("v")).orderBy("i"), "v")
    assert plain == ["h_1", "h_1", ""] and safe[0] != safe[1] and safe[2] is None


def test_pseudonyms_keep_distinct_counts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "c string")
    p = df.select(K.pseudonymize("c", "k").alias("p"), K.pseudonymize("c", "other").alias("q"))
    assert p.agg(F.count_distinct("p")).first()[0] == 2 and p.where("p is null").count() == 1
    assert p.where("length(p) = 64").count() == 3 and p.where("p = q").count() == 0


@pytest.mark.parametrize("token, on", [("false", False), ("0", False), ("NO", False), (" False ", False),
                                       ("flase", True), ("off", True), ("", True), (None, True), ("true", True)])
def test_only_explicit_false_turns_hashing_off(token, on):
    assert pseudonymize_enabled(token) is on


def test_slug_matches_driver_side(spark):
    texts = ["ca-ret:Personal:Overview", "--a__b--", "Régimes / é", "6+"]
    assert col(spark, texts, T.slug("c")) == [T.slug_text(t) for t in texts] == ["ca-ret-personal-overview", "a-b", "régimes-é", "6"]


def test_severity(spark):
    df = spark.createDataFrame([(3.5,), (5.0,), (8.0,), (12.0,)], "z double")
    assert values(df.select(T.severity(F.col("z")).alias("v")), "v") == ["warn", "minor", "major", "critical"]


def test_split_part_takes_literal_delimiters(spark):
    assert col(spark, ["a|b|c", "a"], T.split_part("c", "|", 2)) == ["b", None]
    assert col(spark, ["a.b"], T.split_part("c", ".", 2)) == ["b"]


def test_unknown_options(spark):
    with pytest.raises(ValueError):
        TM.trunc_period("c", "hourly")
    with pytest.raises(ValueError):
        K.page_view_flag("scroll")
