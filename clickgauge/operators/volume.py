"""Volumes, windows and period series of a hit table."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.events import event_presence
from ..functions.text import as_col, count_where, nonblank, pct
from ..functions.time import month_window_start, trunc_period
from ..sources.partitions import Source, as_frame, extremes
from .census import top_n, with_distincts


def daily_volume(df: DataFrame, day: str, scoped: Column, url: str | Column) -> DataFrame:
    """Total, scoped and URL-blank rows per day; rows without a date form their own row."""
    return df.groupBy(F.to_date(as_col(day)).alias("date")).agg(
        F.count(F.lit(1)).alias("total"), count_where(scoped).alias("scoped"),
        count_where(~nonblank(url)).alias("url_blank"))


def month_window(df: Source, day: str, months: int) -> DataFrame:
    """One row: first day of the month ``months`` before the latest data month."""
    return extremes(df, day).select(month_window_start("last", months).alias("start"), "last")


def trailing_window(df: Source, day: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days up to the latest partition (scalar-subquery filter)."""
    first = extremes(df, day).select(F.date_sub(F.col("last").cast("date"), days)).scalar()
    return as_frame(df).where(as_col(day) >= first)


def window_crosscheck(df: DataFrame, daily: DataFrame, day: str, start: str) -> DataFrame:
    """The window's row count against the sum of its daily counts."""
    from .joins import combine_single_rows
    first = F.lit(start).cast("date")
    both = combine_single_rows(
        df.where(as_col(day) >= first).agg(F.count(F.lit(1)).alias("window_rows")),
        daily.where(F.col("date") >= first).agg(F.sum("total").alias("daily_sum")))
    return both.withColumn("equal", F.col("window_rows") == F.col("daily_sum"))


def window_diagnostics(df: DataFrame, suite_match: Column, url_match: Column, url: Column) -> DataFrame:
    """How suite and URL conditions overlap, before any filter."""
    suite_match, url_match = F.coalesce(suite_match, F.lit(False)), F.coalesce(url_match, F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("total"), count_where(suite_match & ~url_match).alias("suite_only"),
        count_where(~suite_match & url_match).alias("url_only"), count_where(suite_match & url_match).alias("both"),
        count_where(~nonblank(url)).alias("url_blank"))


def bot_drop_diagnostics(df: DataFrame, url_match: Column, in_scope: Column, eligible: Column) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"), count_where(url_match).alias("url_match"),
        count_where(in_scope).alias("in_scope"), count_where(in_scope & ~eligible).alias("dropped_in_scope"))


def breakdown(df: DataFrame, value: Column, name: str, k: int | None = None) -> DataFrame:
    """Rows per value with their share of all rows (hosts or suites in scope)."""
    n = df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("rows"))
    total = n.agg(F.sum("rows")).scalar()
    top = n if k is None else top_n(n, k, "rows", name)
    return top.withColumn("pct_of_scope", pct(F.col("rows"), total))


def sample_frame(df: DataFrame, fraction: float, id_col: str, seed: int = 42) -> DataFrame:
    """Seeded sample by hashed id: the same rows whatever the partitioning or retries."""
    bound = f"{int(fraction * 2 ** 32):08x}"
    return df.where(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))), 1, 8) < bound)


def ts_daily(df: DataFrame, day: Column, visit: Column, visitor: Column, clean: Column,
             languages: dict[str, Column], exact: bool = False) -> DataFrame:
    """Daily hits, visits, visitors, clean hits and hits per language in one pass."""
    aggs = [F.count(F.lit(1)).alias("hits"), count_where(clean).alias("clean_hits"),
            *[count_where(c).alias(f"lang_{name}") for name, c in languages.items()]]
    return with_distincts(df, aggs, {"visits": visit, "visitors": visitor}, exact, {"date": F.to_date(day)})


def traffic_series(df: DataFrame, ts: Column, period: str, visit: Column, visitor: Column,
                   by: str | None = None, exact: bool = False) -> DataFrame:
    keys = {"period": trunc_period(ts, period), **({by: F.col(by)} if by else {})}
    return with_distincts(df, [F.count(F.lit(1)).alias("hits")], {"visits": visit, "visitors": visitor}, exact, keys)


def language_mix(df: DataFrame, ts: Column, period: str, language: Column, names: list[str]) -> DataFrame:
    """Hits per period with a column per language, and the share outside the named ones."""
    n = df.groupBy(trunc_period(ts, period).alias("period")).agg(
        F.count(F.lit(1)).alias("hits"), *[count_where(language == v).alias(v) for v in names])
    named = sum((F.col(v) for v in names), F.lit(0))
    return n.withColumn("other_pct", pct(F.col("hits") - named, F.col("hits")))


def event_timeline(df: DataFrame, ts: Column, period: str, events: str, ids: list[str]) -> DataFrame:
    """Hits carrying each tracked event per period."""
    wanted = F.array_intersect(event_presence(events), F.array(*[F.lit(i) for i in ids]))
    return (df.select(trunc_period(ts, period).alias("period"), F.explode(wanted).alias("event_id"))
            .groupBy("period", "event_id").agg(F.count(F.lit(1)).alias("hits")))


def monthly_volume(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy(F.date_format(as_col(day), "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("hits"))


def daily_ratios(daily: DataFrame) -> DataFrame:
    """Hits per visit and visits per visitor over all days."""
    return daily.agg(F.round(F.try_divide(F.sum("hits"), F.sum("visits")), 3).alias("hits_per_visit"),
                     F.round(F.try_divide(F.sum("visits"), F.sum("visitors")), 3).alias("visits_per_visitor"))
