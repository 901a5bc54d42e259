"""Hit timestamps and calendar keys. All parsing is ANSI-safe: bad text gives NULL."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col


def epoch_ts(epoch: str | Column) -> Column:
    """Epoch seconds (any type) to a timestamp."""
    return F.timestamp_seconds(as_col(epoch).try_cast("bigint"))


def event_ts(local: str | Column, epoch: str | Column) -> Column:
    """Local wall-clock text, else epoch seconds. Unparseable text raises under ANSI."""
    return F.coalesce(as_col(local).cast("timestamp"),
                      F.timestamp_seconds(as_col(epoch).cast("bigint")))


def event_ts_safe(local: str | Column, epoch: str | Column) -> Column:
    return F.coalesce(as_col(local).try_cast("timestamp"), epoch_ts(epoch))


def event_ts_chain(local: str | Column, epoch: str | Column, day: str | Column) -> Column:
    """Wall clock, then epoch, then the partition day at midnight."""
    parsed = F.try_to_timestamp(as_col(local), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.coalesce(parsed, epoch_ts(epoch), as_col(day).cast("timestamp"))


def local_ts(epoch: str | Column, tz: str) -> Column:
    return F.from_utc_timestamp(epoch_ts(epoch), tz)


def trunc_period(c: str | Column, period: str = "daily") -> Column:
    c = as_col(c)
    if period == "daily":
        return F.to_date(c)
    if period == "weekly":
        return F.to_date(F.date_trunc("week", c))
    if period == "monthly":
        return F.trunc(F.to_date(c), "month")
    raise ValueError(f"unknown period: {period!r}")


def month_key(c: str | Column) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")


def month_window_start(max_day: str | Column, months: int) -> Column:
    """First day of the month ``months`` before the latest data month."""
    return F.add_months(F.trunc(as_col(max_day), "month"), -months)
