"""Single-series daily KPIs. :mod:`clickgauge.plans.builder` builds whole registries."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.events import list_ids
from ..functions.keys import pv_bucket
from ..functions.text import as_col, count_where, nonblank, ratio0, share_where

DATE = "date"


def _day(c: str | Column) -> Column:
    return F.to_date(as_col(c)).alias(DATE)


def daily_hits(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy(_day(day)).agg(F.count(F.lit(1)).alias("hits"))


def daily_distinct(df: DataFrame, day: str, key: Column, out: str) -> DataFrame:
    """Distinct non-NULL keys per day, as a two-level group-by."""
    keys = df.select(_day(day), key.alias("_key")).where(F.col("_key").isNotNull()).distinct()
    return keys.groupBy(DATE).agg(F.count(F.lit(1)).alias(out))


def _tracked(events: str, ids: Sequence[str]) -> Column:
    """Tokens of interest, dropped before the explode so that it multiplies few rows."""
    wanted = list(ids)
    return F.explode(F.filter(list_ids(events), lambda t: t.isin(wanted))).alias("event_id")


def daily_event_count(df: DataFrame, day: str, events: str, ids: Sequence[str]) -> DataFrame:
    """Token occurrences per day and tracked id."""
    tokens = df.select(_day(day), _tracked(events, ids))
    return tokens.groupBy(DATE, "event_id").agg(F.count(F.lit(1)).alias("n"))


def daily_event_visits(df: DataFrame, day: str, visit: Column, events: str,
                       ids: Sequence[str]) -> DataFrame:
    """Visits carrying each tracked id."""
    keys = df.select(_day(day), visit.alias("_visit"), _tracked(events, ids)).where("_visit is not null")
    return keys.distinct().groupBy(DATE, "event_id").agg(F.count(F.lit(1)).alias("visits"))


def daily_event_rate(df: DataFrame, day: str, events: str, event_id: str) -> DataFrame:
    """Occurrences of one id over hits."""
    ids = df.select(_day(day), list_ids(events).alias("ids"))
    n = F.sum(F.size("ids") - F.size(F.array_remove("ids", event_id)))
    return ids.groupBy(DATE).agg(ratio0(n, F.count(F.lit(1))).alias("rate"))


def daily_dim_share(df: DataFrame, day: str, dim: str, values: Sequence[str]) -> DataFrame:
    """Share of hits per dimension value, all values in one aggregate."""
    hits = F.count(F.lit(1))
    return df.groupBy(_day(day)).agg(
        *[ratio0(count_where(as_col(dim) == v), hits).alias(v) for v in values])


def event_dim_cube(df: DataFrame, day: str, visit: Column, events: str, ids: Sequence[str],
                   dim: str, values: Sequence[str]) -> DataFrame:
    """Visits per event and dimension bucket; unclaimed, NULL and blank values are "other"."""
    bucket = F.when(as_col(dim).isin(list(values)), as_col(dim)).otherwise("other").alias("bucket")
    cells = df.select(_day(day), visit.alias("_visit"), bucket, _tracked(events, ids)).where("_visit is not null")
    return cells.distinct().groupBy(DATE, "event_id", "bucket").agg(F.count(F.lit(1)).alias("visits"))


def visit_page_views(df: DataFrame, day: str, visit: Column, marker: Column) -> DataFrame:
    """Page views per (day, visit): a visit over midnight counts once on each day."""
    hits = df.select(_day(day), visit.alias("_visit"), marker.alias("_pv")).where("_visit is not null")
    return hits.groupBy(DATE, "_visit").agg(F.sum("_pv").alias("pvs"))


def pv_bucket_share(df: DataFrame, day: str, visit: Column, marker: Column) -> DataFrame:
    """Share of a day's visits per page-view bucket; the shares of a day sum to 1."""
    cells = (visit_page_views(df, day, visit, marker).groupBy(DATE, pv_bucket("pvs").alias("bucket"))
             .agg(F.count(F.lit(1)).alias("n")))
    total = F.sum("n").over(Window.partitionBy(DATE))
    return cells.select(DATE, "bucket", ratio0(F.col("n"), total).alias("share"))


def column_population_rate(df: DataFrame, day: str, column: str) -> DataFrame:
    return df.groupBy(_day(day)).agg(share_where(nonblank(column)).alias("rate"))


def low_dispersion_signal(df: DataFrame, day: str, visit: Column, marker: Column,
                          pages: int = 2, window: int = 7) -> DataFrame:
    """Daily share of visits with exactly ``pages`` page views, and how steady it is.

    The window runs over one row per day of a single series.
    """
    daily = (visit_page_views(df, day, visit, marker).groupBy(DATE)
             .agg(share_where(F.col("pvs") == pages).alias("share")))
    recent = Window.partitionBy(F.lit(1)).orderBy(DATE).rowsBetween(-window + 1, 0)
    return daily.withColumn("spread", F.stddev_samp("share").over(recent))
