"""Report suites, segments, geography and mobile traffic."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import mobile_hit, no_null
from ..functions.text import as_col, brand_triple, count_where, nonblank, pct, share_where, split_part
from ..functions.url import url_coalesce
from ..sources.scratch import materialize
from .census import column_families, column_values, population_census, top_n
from .grains import joint_counts
from .series import top_per_group


def _suite_days(df: DataFrame, suite: Column, day: str) -> DataFrame:
    return df.groupBy(suite.alias("suite"), F.to_date(as_col(day)).alias("date")).agg(F.count(F.lit(1)).alias("n"))


def suite_census(df: DataFrame, suite: str, day: str) -> DataFrame:
    """Rows, share, days and readiness gates per suite, from one (suite, day) aggregate."""
    return _census(_suite_days(df, F.lower(F.trim(F.col(suite))), day))


def _census(days: DataFrame) -> DataFrame:
    n = days.groupBy("suite").agg(
        F.sum("n").alias("rows"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.count("date").alias("n_days"))
    total = n.agg(F.sum("rows")).scalar()
    return n.select("*", F.round(F.try_divide(F.col("rows") * 100.0, total), 4).alias("share_pct"),
                    (F.col("n_days") >= 30).alias("clears_30d"), (F.col("n_days") >= 90).alias("clears_90d"))


def suite_monthly(df: DataFrame, suite: str, day: str) -> DataFrame:
    return df.groupBy(F.lower(F.trim(F.col(suite))).alias("suite"), F.date_format(day, "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("hits"))


def suite_hosts(df: DataFrame, suite: str, host: Column, k: int) -> DataFrame:
    n = (df.select(F.lower(F.trim(F.col(suite))).alias("suite"), host.alias("host")).where("host <> ''")
         .groupBy("suite", "host").agg(F.count(F.lit(1)).alias("hits")))
    return top_per_group(n, "suite", k, "hits", "host")


def suite_inventory(df: DataFrame, suite: str, day: str, host: Column, k: int = 10) -> DataFrame:
    """Census, monthly histogram and top hosts of each suite in one row, all from the rows per (suite, day, host) of one pass."""
    joint = materialize(joint_counts(df, {"suite": F.lower(F.trim(F.col(suite))), "date": F.to_date(as_col(day)), "host": host}), "suite-counts")
    days = joint.groupBy("suite", "date").agg(F.sum("n").alias("n"))
    months = days.groupBy("suite", F.date_format("date", "yyyy-MM").alias("month")).agg(F.sum("n").alias("hits")).groupBy("suite").agg(
        F.array_sort(F.collect_list(F.struct("month", "hits"))).alias("monthly"))
    per_host = joint.where("host <> ''").groupBy("suite", "host").agg(F.sum("n").alias("hits"))
    hosts = top_per_group(per_host, "suite", k, "hits", "host").groupBy("suite").agg(
        F.array_sort(F.collect_list(F.struct("rank", "host", "hits"))).alias("top_hosts"))
    return _census(days).join(months, "suite", "left").join(hosts, "suite", "left")


def web_vs_app(df: DataFrame, suite: str, url_cols: Sequence[str], app_cols: Sequence[str],
               web: float = 0.90, app: float = 0.10) -> DataFrame:
    """Is a suite scopable by URL? Rates of URL and app columns and a verdict."""
    rates = [share_where(nonblank(c)).alias(c) for c in [*url_cols, *app_cols]]
    n = df.groupBy(F.col(suite).alias("suite")).agg(
        F.count(F.lit(1)).alias("rows"), *rates, share_where(url_coalesce(*url_cols) != "").alias("any_url_rate"))
    u = F.col("any_url_rate")
    return n.withColumn("verdict", F.when(u >= web, "web").when(u <= app, "app_or_mixed").otherwise("mixed"))


def segment_triples(df: DataFrame, suite: str, tag: str, delim: str, k: int, sketched: bool = False) -> DataFrame:
    """Most frequent (suite, brand, line of business, segment); ``sketched`` finds them, as exact, without a shuffle of all triples."""
    t = df.where(nonblank(tag)).select(F.col(suite).alias("suite"), brand_triple(tag, delim).alias("t")).select("suite", "t.*")
    parts = ["suite", "brand", "lob", "segment"]
    if sketched:
        from .frequent import top_items
        top = top_items(t, {"triple": F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})}, k)
        whole = F.from_json("value", t.schema)
        return top.select(*[whole[c].alias(c) for c in parts], "n")
    n = t.groupBy(*parts).agg(F.count(F.lit(1)).alias("n"))
    return top_n(n, k, "n", *parts)

def scope_sizing(df: DataFrame, segment: Column, url_scope: Column, variants: dict[str, Column]) -> DataFrame:
    """Segment scope against URL scope: what switching would gain and lose."""
    s, u = no_null(segment), no_null(url_scope)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), count_where(s).alias("segment_scope"), count_where(u).alias("url_scope"),
        count_where(s & u).alias("both"), count_where(s & ~u).alias("segment_only"), count_where(~s & u).alias("url_only"),
        *[a for name, v in variants.items() for a in (
            count_where(v).alias(f"{name}_rows"), count_where(v & s).alias(f"{name}_in_segment"))])


def value_rate_by_suite(df: DataFrame, suite: str, column: str, match: Column) -> DataFrame:
    return df.groupBy(F.col(suite).alias("suite")).agg(
        F.count(F.lit(1)).alias("rows"), share_where(nonblank(column)).alias("populated"), share_where(match).alias("match_rate"))


def pagename_prefix_census(df: DataFrame, suite: str, column: str, delim: str = ":", k: int = 25) -> DataFrame:
    prefix = F.trim(split_part(column, delim, 1)).alias("prefix")
    n = df.where(nonblank(column)).groupBy(F.col(suite).alias("suite"), prefix).agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(n, "suite", k, "n", "prefix")


def _ranked_values(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """Top values of several columns from one scan, as shares of all rows."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    top = top_per_group(column_values(df, columns), "column_name", k, "n", "value")
    run = Window.partitionBy("column_name").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return top.select("column_name", "value", "n", pct(F.col("n"), rows).alias("pct"),
                      pct(F.sum("n").over(run), rows).alias("cumulative_pct"))


def geo_distribution(df: DataFrame, levels: dict[str, str], k: int = 25) -> DataFrame:
    """Top values per geographic level (and language), with share and running share."""
    names = F.create_map(*[F.lit(x) for level, column in levels.items() for x in (column, level)])
    ranked = _ranked_values(df, list(levels.values()), k)
    return ranked.select(names[F.col("column_name")].alias("level"), "value", "n", "pct", "cumulative_pct")


def mobile_share(df: DataFrame, app_id: str, source: str) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("rows"), count_where(mobile_hit(app_id, source)).alias("mobile_hits"))
    return n.withColumn("mobile_pct", pct(F.col("mobile_hits"), F.col("rows")))


def mobile_tops(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """Top apps, devices, systems and actions."""
    return _ranked_values(df, columns, k).select("column_name", "value", "n")


# Column families of a mobile feed.
MOBILE_FAMILIES = {
    "app_metadata": "^mobile(app(id|store)?|install|launch|upgrade|day|hour|osenvironment|osversion|resolution|device"
                    "|crashrate|prevsession|ltv|carrier)",
    "message": "^mobilemessage", "place": "^mobileplace", "beacon": "^mobilebeacon",
    "campaign": "^mobile(campaign|acquisition|deeplink|relaunch)",
    "performance": "^mobileappperformance", "crash": "^mobile(crash|appperformancecrash)",
}


def mobile_families(df: DataFrame) -> DataFrame:
    """How many mobile columns of each family exist and are populated."""
    mobile = [c for c in df.columns if c.startswith("mobile")]
    return column_families(population_census(df, mobile), MOBILE_FAMILIES)
