"""URL columns, hosts, inventories and scope decisions."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import no_null
from ..functions.text import count_where, nonblank, pct
from ..functions.url import (host_bucket, host_env_tag, host_path, path_bucket, path_generalize_ids,
                             path_prefix, query_param, url_coalesce, url_host, url_path, url_strip)
from .census import top_n, with_distincts
from .grains import rows_of, shares_of, stored_grains
from .series import cumulative_pct

LOGIN_PATTERN = "(?i)portal|portail|login|auth|signin|member|sso"


def sections(hp: Column, n: int = 5) -> Column:
    """host and the first n - 1 path segments."""
    return F.regexp_extract(hp, f"^([^/]+(?:/[^/]+){{0,{n - 1}}})", 1)


def _long(wide: DataFrame, columns: Sequence[str], stats: Sequence[str], total: str = "rows") -> DataFrame:
    """One-row wide statistics ``{column index}_{stat}`` to one row per column."""
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(total).alias("rows"),
                              *[F.col(f"{i}_{s}").alias(s) for s in stats]) for i, c in enumerate(columns)])
    return wide.select(F.inline(rows))


def url_column_stats(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Per URL column: blank share, distinct host/path, rows equal to the coalesce, rank.

    ``coalesce_rank`` orders the columns by blank share: the recommended coalesce order.
    """
    coalesced = host_path(url_coalesce(*columns))
    aggs, distincts = [F.count(F.lit(1)).alias("rows")], {}
    for i, c in enumerate(columns):
        hp = host_path(F.col(c))
        distincts[f"{i}_distinct_urls"] = hp
        aggs += [count_where(nonblank(c)).alias(f"{i}_nonblank"), count_where(hp == coalesced).alias(f"{i}_matches_coalesce")]
    long = _long(with_distincts(df, aggs, distincts, exact), columns, ["nonblank", "distinct_urls", "matches_coalesce"])
    order = Window.partitionBy(F.lit(1)).orderBy("blank_pct", "column_name")
    return (long.withColumn("blank_pct", pct(F.col("rows") - F.col("nonblank"), F.col("rows")))
            .withColumn("coalesce_rank", F.row_number().over(order)))


def url_column_agreement(df: DataFrame, a: Column, b: Column) -> DataFrame:
    a, b = no_null(a), no_null(b)
    return df.agg(count_where(a & b).alias("both"), count_where(a & ~b).alias("only_a"),
                  count_where(~a & b).alias("only_b"), count_where(~a & ~b).alias("neither"))


def url_scope_tags(df: DataFrame, hp: Column, in_scope: Column, related: Column, noise: Column,
                   language: Column, alt_domain: Column) -> DataFrame:
    tags = {"in_scope": in_scope, "related": related, "noise": noise, "alt_domain": alt_domain}
    out = df.select(sections(hp).alias("section"), language.alias("lang"), (hp != "").alias("has_url"),
                    *[no_null(c).alias(n) for n, c in tags.items()])
    addable = F.col("related") & ~F.col("in_scope") & ~F.col("noise")
    return out.where("has_url").withColumn("addable", addable)


def url_scope_breakdown(tagged: DataFrame) -> DataFrame:
    """How much related traffic the scope misses, and of what sort."""
    add = F.col("addable")
    return tagged.agg(
        F.count(F.lit(1)).alias("nonblank"), count_where(F.col("in_scope")).alias("in_scope"),
        count_where(F.col("related")).alias("related"), count_where(F.col("related") & ~F.col("noise")).alias("related_clean"),
        count_where(add).alias("addable"), count_where(add & (F.col("lang") == "fr")).alias("addable_fr"),
        count_where(add & F.col("alt_domain")).alias("addable_alt_domain"),
        count_where(F.col("related") & F.col("noise")).alias("related_noise"))


def top_addable(tagged: DataFrame, k: int = 25) -> DataFrame:
    n = tagged.groupBy("section", "lang", "alt_domain").agg(count_where(F.col("addable")).alias("n")).where("n > 0")
    return top_n(n, k, "n", "section", "lang")


def url_column_category(df: DataFrame, columns: Sequence[str], strict: str, broad: str) -> DataFrame:
    """Category rows per URL column, and those the coalesce would not find."""
    coalesced = no_null(host_path(url_coalesce(*columns)).rlike(strict))
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        hp = host_path(F.col(c))
        aggs += [count_where(hp.rlike(strict)).alias(f"{i}_strict"), count_where(hp.rlike(broad)).alias(f"{i}_broad"),
                 count_where(hp.rlike(strict) & ~coalesced).alias(f"{i}_beyond_coalesce")]
    return _long(df.agg(*aggs), columns, ["strict", "broad", "beyond_coalesce"])


def pagename_sweep(df: DataFrame, column: str, strict: str, broad: str, exact: bool = False) -> DataFrame:
    name = F.lower(F.col(column))
    n = with_distincts(df, [F.count(F.lit(1)).alias("rows"), count_where(nonblank(column)).alias("nonblank"),
                            count_where(name.rlike(strict)).alias("strict"), count_where(name.rlike(broad)).alias("broad")],
                       {"distinct_names": name}, exact)
    return n.withColumn("blank_pct", pct(F.col("rows") - F.col("nonblank"), F.col("rows")))


def suite_sweep(df: DataFrame, suite: str, category: Column) -> DataFrame:
    """Which suites carry a category of traffic."""
    n = df.where(category).groupBy(suite).agg(F.count(F.lit(1)).alias("hits"))
    return n.withColumn("pct_of_category", pct(F.col("hits"), n.agg(F.sum("hits")).scalar()))


def host_presence(df: DataFrame, host: Column, day: str, needles: Sequence[str]) -> DataFrame:
    """Hits, active days and first/last day of each host needle; absent needles show zero.

    Grouped by day first (needles x days rows), so nothing hit-sized is shuffled.
    """
    flags = df.select(F.col(day).alias("date"), host.alias("_host")).where("_host <> ''")
    per = flags.groupBy("date").agg(*[count_where(F.col("_host").contains(n)).alias(f"n{i}") for i, n in enumerate(needles)])
    rows = F.array(*[F.struct(F.lit(n).alias("needle"), F.col(f"n{i}").alias("n")) for i, n in enumerate(needles)])
    long = per.select("date", F.inline(rows))
    seen = F.col("n") > 0
    return long.groupBy("needle").agg(
        F.sum("n").alias("hits"), count_where(seen).alias("active_days"),
        F.min(F.when(seen, F.col("date"))).alias("first_day"), F.max(F.when(seen, F.col("date"))).alias("last_day"))


def host_presence_monthly(df: DataFrame, host: Column, day: str) -> DataFrame:
    return (df.select(F.date_format(day, "yyyy-MM").alias("month"), host.alias("_host")).where("_host <> ''")
            .groupBy("month").agg(F.count(F.lit(1)).alias("hits")))


def top_hosts(df: DataFrame, host: Column, k: int) -> DataFrame:
    """Largest hosts with share, running share and environment."""
    n = df.select(host.alias("host")).where("host <> ''").groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    return cumulative_pct(n, k, "n", "host").withColumn("env", host_env_tag("host"))


def top_path_prefixes(df: DataFrame, hp: Column, language: Column, k: int, depth: int = 5) -> DataFrame:
    path = path_generalize_ids(url_path(hp))
    n = (df.select(url_host(hp).alias("host"), path_prefix(path, depth).alias("path_prefix"), language.alias("lang"))
         .where("host <> ''").groupBy("host", "path_prefix", "lang").agg(F.count(F.lit(1)).alias("n")))
    return cumulative_pct(n, k, "n", "host", "path_prefix", "lang").withColumn("env", host_env_tag("host"))


def url_inventory(df: DataFrame, columns: Sequence[str], day: str, tags: Mapping[str, Column], depth: int = 5,
                  min_hits: int = 1, exact_days: bool = True) -> DataFrame:
    """One row per host, path, prefix and tags: hits, days, first and last day, fill of each
    source column. Blank urls keep a bucket of their own.

    ``tags`` are columns over ``hp`` (stripped host/path), ``host`` and ``path``. Hits are first
    combined by (url without query, day): the parsing runs once per distinct url and day, and a
    hot url is one row per task.
    """
    fills = [f"src_{i}" for i in range(len(columns))]
    bare = F.substring_index(F.substring_index(url_coalesce(*columns), "?", 1), "#", 1)
    hits = df.select(F.col(day).alias("day"), bare.alias("url"),
                     *[nonblank(c).cast("int").alias(f) for f, c in zip(fills, columns)])
    urls = hits.groupBy("url", "day").agg(F.count(F.lit(1)).alias("hits"), *[F.sum(f).alias(f) for f in fills])
    base = urls.select("day", "hits", *fills, url_strip("url").alias("hp"))
    base = base.withColumn("host", host_bucket(F.col("hp"))).withColumn("path", path_bucket(F.col("hp")))
    base = base.withColumn("path_prefix", path_prefix(path_generalize_ids("path"), depth))
    base = base.withColumns(dict(tags))
    grain = ["host", "path", "path_prefix", *tags]
    per_day = base.groupBy(*grain, "day").agg(F.sum("hits").alias("hits"), *[F.sum(c).alias(c) for c in fills])
    out = per_day.groupBy(*grain).agg(
        F.sum("hits").alias("hits"), F.count("day").alias("active_days"), F.min("day").alias("first_seen"),
        F.max("day").alias("last_seen"), *[F.sum(c).alias(f"src_{n}_nb") for c, n in zip(fills, columns)])
    return out.where(F.col("hits") >= min_hits)


def url_rollup(inventory: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Inventory to prefix grain. Paths are unique within a prefix grain row's host, so they
    are counted distinct over the already small inventory."""
    return inventory.groupBy("host", "path_prefix", *tags).agg(
        F.sum("hits").alias("hits"), F.count_distinct("path").alias("distinct_paths"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def inventory_summary(inventory: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Totals of an inventory and the blank share of every source column."""
    n = inventory.agg(
        F.sum("hits").alias("hits"), F.count(F.lit(1)).alias("inventory_rows"), F.count_distinct("host").alias("hosts"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.coalesce(F.sum(F.when(F.col("host") == "<blank>", F.col("hits"))), F.lit(0)).alias("blank_hits"),
        *[F.sum(f"src_{c}_nb").alias(f"_{c}") for c in columns])
    return n.select("hits", "inventory_rows", "hosts", "first_seen", "last_seen", "blank_hits",
                    *[pct(F.col("hits") - F.col(f"_{c}"), F.col("hits"), 4).alias(f"blank_pct_{c}") for c in columns])


def coverage_report(ranked: DataFrame, k: int, by: str = "n", *tie: str) -> DataFrame:
    """What a top-``k`` list leaves out: truncation is reported, never silent."""
    from .joins import combine_single_rows
    n = combine_single_rows(
        ranked.agg(F.count(F.lit(1)).alias("rows_total"), F.sum(by).alias("hits_total")),
        top_n(ranked, k, by, *tie).agg(F.count(F.lit(1)).alias("rows_emitted"), F.sum(by).alias("hits_emitted")))
    return n.withColumn("truncated", F.col("rows_total") > F.col("rows_emitted")).withColumn(
        "hits_pct_covered", pct(F.col("hits_emitted"), F.col("hits_total"), 4))


def scope_filter_compare(inventory: DataFrame, flags: Sequence[str], uncovered: Column) -> DataFrame:
    """Hits and urls under each scope flag, and those a category has outside all of them."""
    conds = {**{f: F.col(f) for f in flags}, "uncovered": uncovered}
    n = inventory.agg(F.sum("hits").alias("_hits"), *[a for i, c in enumerate(conds.values()) for a in (
        F.coalesce(F.sum(F.when(c, F.col("hits"))), F.lit(0)).alias(f"h{i}"), count_where(c).alias(f"u{i}"))])
    rows = F.array(*[F.struct(F.lit(name).alias("filter"), F.col(f"h{i}").alias("hits"), F.col(f"u{i}").alias("urls"),
                              pct(F.col(f"h{i}"), F.col("_hits"), 4).alias("hits_pct")) for i, name in enumerate(conds)])
    return n.select(F.inline(rows))


def top_uncovered(rollup: DataFrame, uncovered: Column, k: int = 25) -> DataFrame:
    return top_n(rollup.where(uncovered), k, "hits", "host", "path_prefix")


def host_shares(df: DataFrame, host: Column) -> DataFrame:
    """Every host with its hits, share in percent and environment, from one pass whose counts are written."""
    return _with_env(stored_grains(df, {"host": host}))


def _with_env(counts: DataFrame) -> DataFrame:
    return shares_of(counts, "host", of_known=True).withColumn("env", host_env_tag("host"))


def scope_shares(df: DataFrame, host: Column, suite: str, country: str) -> tuple[DataFrame, DataFrame, DataFrame, Column]:
    """(hosts, suites, countries, all rows) as the scope reports take them, from one pass over the hits."""
    counts = stored_grains(df, {"host": host, suite: F.col(suite), country: F.col(country)})
    return _with_env(counts), shares_of(counts, suite), shares_of(counts, country), rows_of(counts, "host")


def unclassified_hosts(hosts: DataFrame, least: float = 0.1, below: float = 1.0) -> DataFrame:
    """Production hosts of some size, but below one percent, out of all of ``host_shares``."""
    return hosts.where((F.col("env") == "prod") & (F.col("pct") >= least) & (F.col("pct") < below))


def _covering(hosts: DataFrame, share: float) -> DataFrame:
    """The served hosts (production and acceptance) that make up ``share`` percent of their hits, largest first.

    A host belongs if those with strictly more hits have less than that; hosts of equal size go together.
    The running sum is over distinct sizes, which are few (their number squared is below twice the hits)."""
    served = hosts.where(F.col("env").isin("prod", "uat"))
    sizes = served.groupBy("n").agg((F.count(F.lit(1)) * F.col("n")).alias("_hits"))
    before = Window.partitionBy(F.lit(1)).orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    needed = (sizes.withColumn("_before", F.coalesce(F.sum("_hits").over(before), F.lit(0)))
              .withColumn("_all", F.sum("_hits").over(Window.partitionBy(F.lit(1))))
              .where(100.0 * F.col("_before") < share * F.col("_all")).agg(F.min("n")).scalar())
    return served.where(F.col("n") >= needed)


def _leader(df: DataFrame, name: str) -> DataFrame:
    return df.orderBy(F.desc("n"), name).limit(1)


def _tier_hosts(hosts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hosts that the tight and the medium tier include."""
    return hosts.orderBy(F.desc(F.col("env") == "prod"), F.desc("n"), "host").limit(1), _covering(hosts, 95.0)


def scope_tiers(hosts: DataFrame, suites: DataFrame, countries: DataFrame, always_exclude: Sequence[str] = ()) -> DataFrame:
    """(tier, part, value): what three ready-made scopes let in and keep out, one row per value.

    tight: the largest suite, production host and country, without any host that is not production;
    medium: suites and countries of one percent or more and the hosts that make up 95 % of served hits,
    without authoring hosts; broad: every suite. Both narrower ones keep out login hosts. ``hosts`` are all
    of :func:`host_shares`, ``suites`` and ``countries`` all (value, n, pct); nothing is ranked away.
    """
    top, covering = _tier_hosts(hosts)
    suite, country = suites.columns[0], countries.columns[0]
    login = hosts.where(F.col("host").rlike(LOGIN_PATTERN))

    def rows(df, tiers, part, value, like=False):
        shown = F.concat(F.lit("%"), value, F.lit("%")) if like else F.col(value).cast("string")
        return df.select(F.explode(F.array(*[F.lit(t) for t in tiers])).alias("tier"), F.lit(part).alias("part"), shown.alias("value"))

    parts = [rows(_leader(suites, suite), ["tight"], "suite", suite), rows(suites.where("pct >= 1.0"), ["medium"], "suite", suite),
             rows(suites, ["broad"], "suite", suite),
             rows(top, ["tight"], "include", F.col("host"), True), rows(covering, ["medium"], "include", F.col("host"), True),
             rows(hosts.where("env <> 'prod'"), ["tight"], "exclude", F.col("host"), True),
             rows(hosts.where("env = 'aem_authoring'"), ["medium"], "exclude", F.col("host"), True),
             rows(login, ["tight", "medium"], "login", F.col("host"), True),
             rows(_leader(countries, country), ["tight"], "country", country), rows(countries.where("pct >= 1.0"), ["medium"], "country", country)]
    if always_exclude:
        fixed = hosts.sparkSession.createDataFrame([(t, "exclude", x) for t in ("tight", "medium", "broad") for x in always_exclude],
                                                   "tier string, part string, value string")
        parts.append(fixed)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def tier_coverage(hosts: DataFrame, suites: DataFrame, total_rows: Column) -> DataFrame:
    """Per tier the share of rows it reaches at most (the lesser of its suites' and its hosts') and the rows that makes."""
    from .joins import combine_single_rows
    top, covering = _tier_hosts(hosts)
    sums = [df.agg(F.coalesce(F.sum("pct"), F.lit(0.0)).alias(name)) for name, df in (
        ("s_tight", _leader(suites, suites.columns[0])), ("s_medium", suites.where("pct >= 1.0")), ("h_tight", top), ("h_medium", covering))]
    n = combine_single_rows(*sums).withColumn("total", total_rows)

    def tier(label, cov):
        return F.struct(F.lit(label).alias("tier"), F.round(cov, 3).alias("hit_coverage_pct"),
                        F.round(F.col("total") * F.round(cov, 3) / 100.0).cast("long").alias("row_estimate"))

    return n.select(F.inline(F.array(tier("tight", F.least("s_tight", "h_tight")), tier("medium", F.least("s_medium", "h_medium")),
                                     tier("broad", F.lit(100.0)))))


def referrer_hosts(df: DataFrame, url: str, k: int = 25) -> DataFrame:
    n = (df.where(nonblank(url)).groupBy(url_host(host_path(F.col(url))).alias("host"))
         .agg(F.count(F.lit(1)).alias("n")))
    return top_n(n, k, "n", "host")


def cid_vs_campaign(df: DataFrame, url: str, campaign: str, key: str = "cid") -> DataFrame:
    """Presence of a url parameter against a campaign column, and equality where both are."""
    cid, camp = query_param(F.lower(F.col(url)), key), F.lower(F.trim(F.col(campaign)))
    has_cid, has_camp = F.length(cid) > 0, nonblank(campaign)
    n = df.agg(
        F.count(F.lit(1)).alias("rows"), count_where(has_cid).alias("cid_rows"), count_where(has_camp).alias("campaign_rows"),
        count_where(has_cid & has_camp).alias("both"), count_where(has_cid & ~has_camp).alias("cid_only"),
        count_where(~has_cid & has_camp).alias("campaign_only"),
        count_where(has_cid & has_camp & (cid == camp)).alias("equal_when_both"))
    return n.withColumn("agreement", F.try_divide(F.col("equal_when_both"), F.col("both")))
