"""Each rule resolves uniquely on its own link; anti-tokens and raw-language tokens matter."""
from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from clickgauge.functions import predicates as P
from clickgauge.catalog.filters import RULES


@pytest.fixture(scope="module")
def matrix(spark):
    df = spark.createDataFrame([(r.key, r.href) for r in RULES], "own string, href string")
    rows = df.select("own", *[P.rule_match(r, "href").alias(r.key) for r in RULES]).collect()
    return {r["own"]: {k: r[k] for k in r.asDict() if k != "own"} for r in rows}


@pytest.mark.parametrize("key", [r.key for r in RULES])
def test_rule_matches_only_its_own_link(matrix, key):
    assert [k for k, hit in matrix[key].items() if hit] == [key]


def test_without_language_tokens_rules_collide(spark):
    loose = [replace(r, lang_token="") for r in RULES]
    df = spark.createDataFrame([(RULES[0].href,)], "href string")
    assert df.select(sum(F.when(P.rule_match(r, "href"), 1).otherwise(0) for r in loose).alias("n")).first()["n"] == 2


def test_anti_token_excludes(spark):
    app = next(r for r in RULES if r.rule_id == "app")
    df = spark.createDataFrame([(app.href + "&hl=en",), (app.href,), (None,)], "href string")
    assert [r[0] for r in df.select(P.rule_match(app, "href")).collect()] == [False, True, False]


def test_login_exclusion_on_hrefs_would_delete_the_rules(spark):
    """The exclusion is for page urls: every rule points at a login host."""
    df = spark.createDataFrame([(r.key, r.href) for r in RULES], "k string, href string")
    assert df.where(P.scope_login_exclude(F.lower("href"), ["%id.example.com%"])).count() == 0


def test_any_rule_is_null_safe(spark):
    df = spark.createDataFrame([(None,), ("https://elsewhere.example",)], "href string")
    assert df.where(~P.any_rule(RULES, "href")).count() == 2


def test_strategies_merge_as_declared(spark):
    df = spark.createDataFrame([(r.href, r.link_name) for r in RULES], "href string, name string")
    member_fr = RULES[1]
    ways = P.rule_strategies(member_fr, "href", "name")
    got = df.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in ways.items()]).first().asDict()
    assert got["exact"] == 1 and got["token"] == 1 and got["path"] == 4 and got["token_name"] == 1
