"""Fidelity of a table against an expected profile.

A profile is ordinary data: frames with the expected counts, shares or percentiles. Each
check joins measured to expected and returns one row per item with ``ok``; nothing is
collected, and :func:`summary` folds a check to PASS or FAIL.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.events import event_presence, raw_tokens
from ..functions.text import as_col, count_where, nonblank, qcol
from ..sources.scratch import materialize
from .census import as_text, population_census
from .grains import with_expected
from .series import top_per_group


def summary(check: DataFrame, name: str) -> DataFrame:
    n = check.agg(F.count(F.lit(1)).alias("items"), count_where(~F.coalesce(F.col("ok"), F.lit(False))).alias("failed"))
    return n.select(F.lit(name).alias("check"), "items", "failed", F.when(F.col("failed") == 0, "PASS").otherwise("FAIL").alias("status"))


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0.0))


def fid_daily_counts(df: DataFrame, day: str, expected: DataFrame) -> DataFrame:
    """Exact rows per day; a day on one side only fails. ``expected``: date, hits."""
    got = df.groupBy(F.to_date(as_col(day)).alias("date")).agg(F.count(F.lit(1)).alias("actual"))
    both = got.join(expected.select("date", F.col("hits").alias("expected")), "date", "full_outer")
    return both.withColumn("ok", F.coalesce(F.col("actual") == F.col("expected"), F.lit(False)))


def fid_dow_index(daily: DataFrame, expected: DataFrame, tol: float = 0.05) -> DataFrame:
    """Weekday index (normalised by the mean of the weekday means). ``expected``: dow, dow_index."""
    per = daily.groupBy(F.weekday("date").alias("dow")).agg(F.avg("value").alias("m"))
    mean = per.agg(F.avg("m")).scalar()
    got = per.select("dow", F.try_divide(F.col("m"), mean).alias("actual"))
    both = got.join(expected.select("dow", F.col("dow_index").alias("expected")), "dow")
    return both.withColumn("ok", F.abs(F.col("actual") - F.col("expected")) < tol)


def hour_shares(df: DataFrame, ts: Column) -> DataFrame:
    """Share of a weekday's hits per hour."""
    from pyspark.sql import Window
    n = df.select(ts.alias("t")).where("t is not null").groupBy(F.weekday("t").alias("dow"), F.hour("t").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return n.select("dow", "hour", (F.col("n") / F.sum("n").over(Window.partitionBy("dow"))).alias("share"))


def fid_hour_shares(df: DataFrame, ts: Column, expected: DataFrame, weekday_tol: float = 1.0,
                    weekend_tol: float = 1.5) -> DataFrame:
    """Mean absolute difference of the 24 hour shares, per weekday, in percentage points."""
    got = hour_shares(df, ts).withColumnRenamed("share", "actual")
    both = got.join(expected.select("dow", "hour", F.col("share").alias("expected")), ["dow", "hour"], "full_outer")
    mean = both.groupBy("dow").agg((F.sum(F.abs(_zero("actual") - _zero("expected"))) / 24 * 100).alias("mean_delta_pp"),
                                   F.count("actual").alias("hours"))
    tol = F.when(F.col("dow") >= 5, weekend_tol).otherwise(weekday_tol)
    return mean.where("hours > 0").select("dow", "mean_delta_pp", (F.col("mean_delta_pp") <= tol).alias("ok"))


def fid_population(df: DataFrame, expected: DataFrame, columns: Sequence[str], tol: float = 1.0) -> DataFrame:
    """Non-blank percentage per column. ``expected``: column_name, pop_pct."""
    got = population_census(df, columns).select("column_name", F.col("pop_pct").alias("actual"))
    both = got.join(expected.select("column_name", F.col("pop_pct").alias("expected")), "column_name")
    return both.withColumn("ok", F.abs(F.col("actual") - F.col("expected")) < tol)


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n) with the blank values of a column as one NULL, so that each column sums up to all rows."""
    long = as_text(df, columns).unpivot([], [qcol(c) for c in columns], "column_name", "value")
    return long.groupBy("column_name", F.when(nonblank("value"), F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def dim_profile(df: DataFrame, columns: Sequence[str], k: int = 10) -> tuple[DataFrame, DataFrame]:
    """Expected side of :func:`fid_dims`: top value shares, and coverage with distinct values, from one pass."""
    counts = materialize(_value_counts(df, columns), "value-counts")
    known, n = counts.where("value is not null"), F.col("n")
    per = counts.groupBy("column_name").agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("value").isNotNull(), n)).alias("known"),
                                            F.count("value").alias("distinct_values"))
    shares = top_per_group(known, "column_name", k, "n", "value").join(per, "column_name").select(
        "column_name", "value", (n / F.col("rows") * 100).alias("share_pct"))
    cover = per.where("known is not null").select("column_name", (F.col("known") / F.col("rows") * 100).alias("coverage_pct"), "distinct_values")
    return shares, cover


def fid_dims(df: DataFrame, columns: Sequence[str], shares: DataFrame, cover: DataFrame, share_tol: float = 1.5,
             cover_tol: float = 1.0, distinct_floor: float = 0.8) -> DataFrame:
    """Top value shares, coverage and distinct values of the dimensions, from one scan.

    ``shares`` and ``cover`` are as :func:`dim_profile` returns them; a column has a few expected shares.
    """
    n, value = F.col("n"), F.col("value")
    both = with_expected(_value_counts(df, columns), shares, ["column_name", "value"], "share_pct")
    per = both.groupBy("column_name").agg(
        F.sum("n").alias("rows"), F.sum(F.when(value.isNotNull(), n)).alias("known"), F.count(F.when(value.isNotNull() & (n > 0), 1)).alias("distinct"),
        F.collect_list(F.when(F.col("share_pct").isNotNull(), F.struct("value", "share_pct", "n"))).alias("expected"))
    known = per.join(cover, "column_name", "left")

    def item(kind: str, expected: Column, actual: Column, ok, value: Column = F.lit(None).cast("string")) -> Column:
        actual = F.coalesce(actual.cast("double"), F.lit(0.0))
        return F.struct(F.lit(kind).alias("item"), value.alias("value"), expected.cast("double").alias("expected"), actual.alias("actual"), ok(expected, actual).alias("ok"))

    def near(tol: float):
        return lambda e, a: F.abs(a - e) <= tol

    rows = F.col("rows")
    items = F.concat(F.transform("expected", lambda x: item("share", x["share_pct"], F.try_divide(x["n"].cast("double"), rows) * 100, near(share_tol), x["value"])),
                     F.when(F.col("coverage_pct").isNotNull(), F.array(
                         item("coverage", F.col("coverage_pct"), F.try_divide(F.col("known").cast("double"), rows) * 100, near(cover_tol)),
                         item("distinct", F.col("distinct_values"), F.col("distinct"), lambda e, a: a >= e * distinct_floor)))
                     .otherwise(F.array().cast("array<struct<item:string,value:string,expected:double,actual:double,ok:boolean>>")))
    return known.select("column_name", F.inline(items))


def _event_counts(df: DataFrame, events: str) -> DataFrame:
    """(kind, item, n): hits per list size and per event carried, in one pass."""
    size = F.struct(F.lit("size").alias("kind"), F.size(raw_tokens(events)).cast("string").alias("item"))
    carried = F.transform(event_presence(events), lambda e: F.struct(F.lit("event").alias("kind"), e.alias("item")))
    tags = F.concat(F.array(size), F.coalesce(carried, F.array().cast("array<struct<kind:string,item:string>>")))
    return df.select(F.inline(tags)).groupBy("kind", "item").agg(F.count(F.lit(1)).alias("n"))


def _sizes(counts: DataFrame, *more: Column) -> DataFrame:
    """One row: list-size percentiles and maximum, and the number of hits."""
    size = F.when(F.col("kind") == "size", F.col("item").cast("int"))
    return counts.agg(F.percentile(size, [0.5, 0.95], F.col("n")).alias("p"), F.max(size).cast("double").alias("hi"),
                      F.sum(F.when(F.col("kind") == "size", F.col("n"))).alias("rows"), *more)


def event_profile(df: DataFrame, events: str) -> tuple[DataFrame, DataFrame]:
    """Expected side of :func:`fid_events`: list-size percentiles and inclusion shares, from one pass."""
    counts = materialize(_event_counts(df, events), "event-counts")
    stats = F.array(*[F.struct(F.lit(k).alias("item"), c.alias("value")) for k, c in (("p50", F.col("p")[0]), ("p95", F.col("p")[1]), ("max", F.col("hi")))])
    rows = counts.where("kind = 'size'").agg(F.sum("n")).scalar()
    return _sizes(counts).select(F.inline(stats)), counts.where("kind = 'event'").select("item", (F.col("n") / rows * 100).alias("value"))


def fid_events(df: DataFrame, events: str, sizes: DataFrame, inclusion: DataFrame, size_tol: float = 1.0,
               incl_tol: float = 1.0) -> DataFrame:
    """List-size percentiles within one, a maximum not above, inclusion within one point, from one scan.

    ``sizes`` has three rows, ``inclusion`` one for each known event."""
    expected = sizes.select(F.lit("expected").alias("kind"), "item", "value").unionByName(inclusion.select(F.lit("event").alias("kind"), "item", "value"))
    both = with_expected(_event_counts(df, events), expected, ["kind", "item"], "value")
    one = _sizes(both, F.collect_list(F.when(F.col("value").isNotNull(), F.struct("kind", "item", "value", "n"))).alias("expected"))
    size = F.create_map(F.lit("p50"), F.col("p")[0], F.lit("p95"), F.col("p")[1], F.lit("max"), F.col("hi"))
    rows = F.col("rows")

    def judged(x: Column) -> Column:
        event = x["kind"] == "event"
        actual = F.coalesce(F.when(event, F.try_divide(x["n"].cast("double"), rows) * 100).otherwise(F.element_at(size, x["item"])), F.lit(0.0))
        near = F.abs(actual - x["value"])
        ok = F.when(event, near <= incl_tol).when(x["item"] == "max", actual <= x["value"]).otherwise(near <= size_tol)
        return F.struct(x["item"].alias("item"), x["value"].alias("expected"), actual.alias("actual"), ok.alias("ok"))

    return one.select(F.inline(F.transform("expected", judged)))


def fid_identity(df: DataFrame, key: Sequence[str], visitor: str, expected_visitors: Column, visitor_shape: str,
                 forbidden: dict[str, str], band: float = 0.10) -> DataFrame:
    """Duplicate keys, visitors within a band, id shape, and columns that must not look real.

    Shapes are checked on every row, not on the first one or a prefix.
    """
    from .joins import combine_single_rows
    keys = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg((F.sum("n") - F.count(F.lit(1))).cast("double").alias("dup"))
    people = df.groupBy(visitor).agg(F.count(F.lit(1)).alias("n")).where(nonblank(visitor)).agg(
        F.count(F.lit(1)).cast("double").alias("visitors"), F.try_divide(F.sum("n").cast("double"), F.count(F.lit(1))).alias("hpv"))
    bad = df.agg(count_where(nonblank(visitor) & ~F.col(visitor).rlike(visitor_shape)).cast("double").alias("misshapen"),
                 *[count_where(F.col(c).rlike(p)).cast("double").alias(f"real_{c}") for c, p in forbidden.items()])
    n = combine_single_rows(keys, people, bad).withColumn("want", expected_visitors.cast("double"))

    def item(name, actual, ok):
        return F.struct(F.lit(name).alias("item"), actual.alias("actual"), ok.alias("ok"))

    near = F.col("visitors").between(F.col("want") * (1 - band), F.col("want") * (1 + band))
    rows = [item("duplicate_keys", F.col("dup"), F.col("dup") == 0), item("hits_per_visitor", F.col("hpv"), F.lit(True)),
            item("distinct_visitors", F.col("visitors"), near), item("misshapen_ids", F.col("misshapen"), F.col("misshapen") == 0)]
    rows += [item(f"realistic_{c}", F.col(f"real_{c}"), F.col(f"real_{c}") == 0) for c in forbidden]
    return n.select(F.inline(F.array(*rows)))


def fid_clock_skew(df: DataFrame, local: Column, epoch: str | Column, expected: tuple[int, int, int]) -> DataFrame:
    """Exact p5/p50/p95 of the clock skew."""
    from .feedquality import clock_skew
    got = clock_skew(df, local, epoch, interpolate=True)
    rows = F.array(*[F.struct(F.lit(p).alias("item"), F.lit(e).cast("double").alias("expected"), F.col(p).alias("actual"),
                              (F.col(p).cast("int") == e).alias("ok")) for p, e in zip(("p5", "p50", "p95"), expected)])
    return got.select(F.inline(rows))
