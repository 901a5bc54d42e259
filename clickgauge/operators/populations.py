"""Visit-grain shapes and daily series of competing populations."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import count_flag, flag_words, or_words, pv_bucket
from ..functions.predicates import LinkRule, any_rule, no_null, rule_match
from ..functions.text import as_col, count_where, ratio0, share_where
from .joins import combine_single_rows, visit_overlap


def visits_with_views(df: DataFrame, day: str, visit: Column, marker: Column) -> DataFrame:
    """One row per visit, dated by its first day (a visit over midnight counts once)."""
    return df.select(F.to_date(as_col(day)).alias("_d"), visit.alias("visit"), marker.alias("_pv")).groupBy("visit").agg(
        F.count(F.lit(1)).alias("hits"), F.sum("_pv").alias("pvs"), F.min("_d").alias("date"))


def visit_shape(visits: DataFrame) -> DataFrame:
    return visits.agg(
        F.count(F.lit(1)).alias("visits"), F.try_divide(F.sum("pvs").cast("double"), F.count(F.lit(1))).alias("pv_per_visit"),
        share_where(F.col("pvs") == 0).alias("share_eq_0"), share_where(F.col("pvs") == 2).alias("share_eq_2"))


def visit_buckets(visits: DataFrame) -> DataFrame:
    return visits.groupBy(pv_bucket("pvs").alias("bucket")).agg(F.count(F.lit(1)).alias("visits"))


def visit_shape_daily(visits: DataFrame) -> DataFrame:
    return visits.groupBy("date").agg(
        F.count(F.lit(1)).alias("visits"), ratio0(F.sum("pvs"), F.count(F.lit(1))).alias("pv_per_visit"),
        share_where(F.col("pvs") == 2).alias("share_eq_2"))


def distinct_per_day(df: DataFrame, day: str, keys: Mapping[str, Column]) -> DataFrame:
    """Distinct values of several keys per day: each key is a tagged row, reduced to distinct
    (day, key, value) before the count, so all keys share one scan and one shuffle."""
    pairs = F.array(*[F.struct(F.lit(n).alias("k"), c.cast("string").alias("v")) for n, c in keys.items()])
    long = df.select(F.to_date(as_col(day)).alias("date"), F.inline(pairs)).where("v is not null").distinct()
    return long.groupBy("date").agg(*[count_where(F.col("k") == n).alias(n) for n in keys])


def visitor_grain(df: DataFrame, day: str, visitor: Column, pair: Column) -> DataFrame:
    return distinct_per_day(df, day, {"by_id": visitor, "by_pair": pair})


def population_series(df: DataFrame, day: str, populations: Mapping[str, Column], visit: Column, visitor: Column,
                      pair: Column, marker: Column) -> DataFrame:
    """Daily hits, page views, visits and visitors of several populations, in one scan.

    A hit is repeated per population and per key; both the rows and the keys are combined by
    (population, day, key) before the only wide shuffle. Every hit has one "visits" row (its
    key may be NULL), so hits and page views are read off those.
    """
    tags = F.array_compact(F.array(*[F.when(no_null(c), F.lit(n)) for n, c in populations.items()]))
    keys = {"visits": visit, "visitors": visitor, "visitors_pair": pair}
    rows = df.select(F.to_date(as_col(day)).alias("date"), marker.alias("_pv"), *[c.cast("string").alias(k) for k, c in keys.items()],
                     F.explode(tags).alias("population"))
    rows = rows.select("population", "date", "_pv", F.inline(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(k).alias("v")) for k in keys])))
    cells = rows.groupBy("population", "date", "k", "v").agg(F.count(F.lit(1)).alias("n"), F.sum("_pv").alias("pvs"))
    once = F.col("k") == "visits"
    return cells.groupBy("population", "date").agg(
        F.sum(F.when(once, F.col("n"))).alias("hits"), F.sum(F.when(once, F.col("pvs"))).alias("page_views"),
        *[count_where((F.col("k") == k) & F.col("v").isNotNull()).alias(k) for k in keys])


def rule_visit_contrib(df: DataFrame, rules: Sequence[LinkRule], href: str, visit: Column) -> DataFrame:
    """Distinct visits per rule, all rules in one pass."""
    flagged = df.select(visit.alias("_v"), *flag_words([rule_match(r, href) for r in rules])).where("_v is not null")
    per = flagged.groupBy("_v").agg(*or_words(len(rules)))
    rows = F.array(*[F.struct(F.lit(r.key).alias("rule"), F.col(r.key).alias("visits")) for r in rules])
    return per.agg(*[count_flag(i).alias(r.key) for i, r in enumerate(rules)]).select(F.inline(rows))


def population_verdict(daily: DataFrame, floor: int = 100) -> DataFrame:
    """Is a daily population large enough? Frame: [population, date, visits]."""
    from .series import upper_median
    return daily.groupBy("population").agg(
        upper_median("visits").cast("long").alias("median_visits"), F.min("visits").alias("min_visits"), F.max("visits").alias("max_visits"),
        count_where(F.col("visits") < floor).alias("days_below"), count_where(F.col("visits") == 0).alias("days_zero"),
        F.count(F.lit(1)).alias("days"))


def key_cardinality(df: DataFrame, parts: Mapping[str, Column], exact: bool = False) -> DataFrame:
    from .census import with_distincts
    return with_distincts(df, [F.count(F.lit(1)).alias("_rows")], parts, exact).drop("_rows")


def tag_vs_rules(df: DataFrame, tagged: Column, rules: Sequence[LinkRule], href: str, visit: Column) -> DataFrame:
    """A brand tag against the link rules, on hits and on visits."""
    tagged, ruled = no_null(tagged), any_rule(rules, href)
    hits = df.agg(
        F.count(F.lit(1)).alias("rows"), count_where(tagged).alias("tagged_hits"), count_where(ruled).alias("rule_hits"),
        count_where(tagged & ruled).alias("both_hits"), count_where(ruled & ~tagged).alias("rule_untagged_hits"))
    visits = visit_overlap(df, visit, ruled, tagged).select(
        F.col("visits_a").alias("rule_visits"), F.col("visits_b").alias("tagged_visits"), F.col("both").alias("both_visits"),
        F.col("a_only").alias("rule_only_visits"), F.col("b_only").alias("tagged_only_visits"))
    return combine_single_rows(hits, visits)


def rule_tagged_share(df: DataFrame, tagged: Column, rules: Sequence[LinkRule], href: str) -> DataFrame:
    tagged = no_null(tagged)
    aggs = [a for i, r in enumerate(rules) for a in (
        count_where(rule_match(r, href)).alias(f"m{i}"), count_where(rule_match(r, href) & tagged).alias(f"t{i}"))]
    rows = F.array(*[F.struct(F.lit(r.key).alias("rule"), F.col(f"m{i}").alias("matched"), F.col(f"t{i}").alias("also_tagged"),
                              F.try_divide(F.col(f"t{i}"), F.col(f"m{i}")).alias("tagged_share")) for i, r in enumerate(rules)])
    return df.agg(*aggs).select(F.inline(rows))
