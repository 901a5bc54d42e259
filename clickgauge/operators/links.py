"""Link clicks: censuses, rule comparison and language derivations."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import STRATEGIES, LinkRule, any_rule, no_null, rule_match, rule_strategies
from ..functions.text import as_col, count_where, flag, nonblank, share_where
from ..functions.url import UNKNOWN, lang_from_value
from .census import top_n, with_distincts


def link_census(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Fill, distinct values and lengths of the link columns (a column cap shows as len_max)."""
    aggs, rows, distincts = [], [], {}
    for i, c in enumerate(columns):
        v = F.when(nonblank(c), F.col(c).cast("string"))
        distincts[f"d{i}"] = v
        aggs += [share_where(nonblank(c)).alias(f"r{i}"), F.min(F.length(v)).alias(f"lo{i}"),
                 F.max(F.length(v)).alias(f"hi{i}"), F.percentile_approx(F.length(v), [0.5, 0.95, 0.99]).alias(f"p{i}")]
        rows.append(F.struct(F.lit(c).alias("column_name"), F.col(f"r{i}").alias("nonblank_rate"), F.col(f"d{i}").alias("distinct_values"),
                             F.col(f"lo{i}").alias("len_min"), F.col(f"hi{i}").alias("len_max"), F.col(f"p{i}")[0].alias("len_p50"),
                             F.col(f"p{i}")[1].alias("len_p95"), F.col(f"p{i}")[2].alias("len_p99")))
    return with_distincts(df, aggs, distincts, exact).select(F.inline(F.array(*rows)))


def link_encoding(df: DataFrame, href: str, name: str, marks: Mapping[str, str]) -> DataFrame:
    """Encoding marks of the stored hrefs, and hrefs and names that occur alone."""
    raw = F.lower(F.col(href))
    return df.agg(
        count_where(nonblank(href)).alias("hrefs"), *[count_where(raw.rlike(p)).alias(k) for k, p in marks.items()],
        count_where(nonblank(href) & ~nonblank(name)).alias("href_without_name"),
        count_where(~nonblank(href) & nonblank(name)).alias("name_without_href"))


# Signs that an href was stored raw, stripped or encoded.
ENCODING_MARKS = {
    "has_query": r"\?", "has_fragment": "#", "pct_encoded": "%[0-9a-f]{2}", "pct_3a": "%3a", "pct_2f": "%2f",
    "has_goto": "goto=", "has_ui_locales": "ui_locales",
}


def rule_compare(df: DataFrame, rules: Sequence[LinkRule], href: str, name: str) -> DataFrame:
    """Hits per rule under every strategy, and how accented link names are stored."""
    label = F.lower(F.trim(F.col(name)))
    aggs, rows = [], []
    for i, r in enumerate(rules):
        aggs += [count_where(c).alias(f"{k}{i}") for k, c in rule_strategies(r, href, name).items()]
        for side, text in (("true", r.link_name), ("garbled", r.link_name_garbled)):
            wanted = label == text.lower() if r.link_name_garbled else F.lit(False)
            aggs.append(count_where(wanted).alias(f"name_{side}{i}"))
        rows.append(F.struct(F.lit(r.key).alias("rule"), *[F.col(f"{k}{i}").alias(k) for k in STRATEGIES],
                             F.col(f"name_true{i}").alias("name_true"), F.col(f"name_garbled{i}").alias("name_garbled")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def rule_collisions(df: DataFrame, rules: Sequence[LinkRule], href: str, name: str) -> DataFrame:
    """How many rules one hit satisfies, by path and by token matching."""
    out = None
    for strategy in ("path", "token"):
        n = F.lit(0)
        for r in rules:
            n = n + flag(rule_strategies(r, href, name)[strategy])
        part = df.where(nonblank(href)).groupBy(n.alias("rules_matched")).agg(F.count(F.lit(1)).alias("hits")).select(
            F.lit(strategy).alias("strategy"), "rules_matched", "hits")
        out = part if out is None else out.unionByName(part)
    return out


def rule_daily(df: DataFrame, rules: Sequence[LinkRule], href: str, day: str) -> DataFrame:
    """Long daily series of hits per rule, zero on days without a match."""
    n = df.groupBy(F.to_date(as_col(day)).alias("date")).agg(*[count_where(rule_match(r, href)).alias(r.key) for r in rules])
    return n.unpivot(["date"], [r.key for r in rules], "metric_id", "value")


def rule_unmatched(df: DataFrame, rules: Sequence[LinkRule], href: str, k: int = 25) -> DataFrame:
    n = df.where(nonblank(href) & ~any_rule(rules, href)).groupBy(F.col(href).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return top_n(n, k, "n", "value")


def rule_page_context(df: DataFrame, rules: Sequence[LinkRule], href: str, page_url: Column, scopes: Mapping[str, Column],
                      login_page: Column, login_href: Column) -> DataFrame:
    """Where each rule's clicks happen: inside which scope, on or towards which login host."""
    conds = {"matched": F.lit(True), **scopes, "page_on_login_host": login_page, "href_to_login_host": login_href,
             "page_url_blank": ~nonblank(page_url)}
    outside = F.lit(True)
    for c in scopes.values():
        outside = outside & ~no_null(c)
    conds["in_no_scope"] = outside
    aggs = [count_where(rule_match(r, href) & no_null(c)).alias(f"{k}_{i}") for i, r in enumerate(rules) for k, c in conds.items()]
    rows = F.array(*[F.struct(F.lit(r.key).alias("rule"), *[F.col(f"{k}_{i}").alias(k) for k in conds]) for i, r in enumerate(rules)])
    return df.agg(*aggs).select(F.inline(rows))


def lang_counts(df: DataFrame, ways: Mapping[str, Column]) -> DataFrame:
    """Hits per derivation and language."""
    one = df.select(*[c.alias(n) for n, c in ways.items()])
    return one.unpivot([], list(ways), "derivation", "language").groupBy("derivation", "language").agg(F.count(F.lit(1)).alias("hits"))


def lang_agreement(df: DataFrame, ways: Mapping[str, Column]) -> DataFrame:
    """For every pair of derivations: hits both can decide, and on which they agree."""
    tagged = df.select(*[c.alias(n) for n, c in ways.items()])
    names = list(ways)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    aggs, rows = [], []
    for i, (a, b) in enumerate(pairs):
        both = (F.col(a) != UNKNOWN) & (F.col(b) != UNKNOWN)
        aggs += [count_where(both).alias(f"n{i}"), count_where(both & (F.col(a) == F.col(b))).alias(f"s{i}")]
        rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"n{i}").alias("comparable"), F.col(f"s{i}").alias("agree"),
                             F.try_divide(F.col(f"s{i}"), F.col(f"n{i}")).alias("agreement")))
    return tagged.agg(*aggs).select(F.inline(F.array(*rows)))


def lang_by_rule(df: DataFrame, rules: Sequence[LinkRule], href: str, ways: Mapping[str, Column]) -> DataFrame:
    """Hits per rule, derivation and language (a hit counts under every rule it satisfies)."""
    matched = F.array_compact(F.array(*[F.when(rule_match(r, href), F.lit(r.key)) for r in rules]))
    tagged = df.select(matched.alias("_rules"), *[c.alias(n) for n, c in ways.items()]).where(F.size("_rules") > 0)
    long = tagged.unpivot(["_rules"], list(ways), "derivation", "language")
    return long.select(F.explode("_rules").alias("rule"), "derivation", "language").groupBy("rule", "derivation", "language").agg(
        F.count(F.lit(1)).alias("hits"))


def lang_disagreement(df: DataFrame, tagged: str, derived: Column) -> DataFrame:
    """A tagged language column against the derived language, where both are known."""
    tag = lang_from_value(tagged)
    both = tag.isNotNull() & (derived != UNKNOWN)
    n = df.agg(count_where(both).alias("comparable"), count_where(both & (tag != derived)).alias("disagree"))
    return n.withColumn("disagree_pct", F.round(F.try_divide(F.col("disagree") * 100.0, F.col("comparable")), 3))
