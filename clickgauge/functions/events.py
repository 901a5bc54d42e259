"""Comma-delimited event lists such as ``"20=1,10036,500=2.5"``."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import as_col, nonblank

NO_LABEL = "unknown event"
PENDING_LABEL = "pending confirmation"
# Id ranges that count instances of custom variables, and the offset to N.
INSTANCE_RANGES = ((100, 199, 99), (10000, 10099, 9899))


def raw_tokens(c: str | Column) -> Column:
    """Trimmed non-empty tokens; an empty array for NULL or blank lists."""
    trimmed = F.transform(F.split(as_col(c), ","), lambda t: F.trim(t))
    return F.when(nonblank(c), F.filter(trimmed, lambda t: t != "")).otherwise(
        F.array().cast("array<string>"))


def bare_id(token: Column) -> Column:
    return F.trim(F.substring_index(token, "=", 1))


def bare_ids(c: str | Column) -> Column:
    """Ids without values, spaces and blanks; NULL for a NULL list. One pass over the list."""
    return F.array_remove(F.transform(F.split(as_col(c), ","), bare_id), "")


def event_list_normalize(c: str | Column) -> Column:
    """Drop ``=value`` suffixes, blanks and spaces; NULL stays NULL."""
    return F.array_join(bare_ids(c), ",")


def event_tokens(c: str | Column) -> Column:
    """array<struct<id, value>>; value is NULL when absent or not numeric."""
    return F.transform(raw_tokens(c), lambda t: F.struct(
        bare_id(t).alias("id"),
        F.try_element_at(F.split(t, "="), F.lit(2)).try_cast("double").alias("value")))


def event_presence(c: str | Column) -> Column:
    """Distinct ids carried by the hit."""
    return F.coalesce(F.array_distinct(bare_ids(c)), F.array().cast("array<string>"))


def list_ids(c: str | Column) -> Column:
    """Ids of an already normalised list."""
    return F.split(F.coalesce(as_col(c), F.lit("")), ",")


def event_contains(c: str | Column, event_id: str) -> Column:
    return F.array_contains(list_ids(c), event_id)


def event_count(c: str | Column, event_id: str) -> Column:
    """Occurrences of one id in a normalised list, without exploding it."""
    return F.size(F.filter(list_ids(c), lambda t: t == event_id))


def instance_number(event_id: str | Column) -> Column:
    n = as_col(event_id).try_cast("int")
    out = F.lit(None).cast("int")
    for lo, hi, offset in INSTANCE_RANGES:
        out = F.when(n.between(lo, hi), n - offset).otherwise(out)
    return out


def with_event_label(df: DataFrame, id_col: str, lookup: DataFrame,
                     standard: dict[str, str] | None = None, pending: tuple[str, ...] = (),
                     out: str = "label") -> DataFrame:
    """Label ids: lookup, then standard names, pending ids, the instance formula, unknown.

    ``lookup`` is (event_id, label). It is left to Spark to broadcast it when it is small.
    """
    lk = lookup.select(F.col("event_id").alias("_lk_id"), F.col("label").alias("_lk_label"))
    eid = F.col(id_col)
    named = F.lit(None).cast("string")
    for code, label in (standard or {}).items():
        named = F.when(eid == code, label).otherwise(named)
    waiting = F.when(eid.isin(list(pending)), PENDING_LABEL) if pending else F.lit(None)
    n = instance_number(eid)
    formula = F.when(n.isNotNull(), F.concat(F.lit("Instance of eVar"), n))
    joined = df.join(lk, eid == F.col("_lk_id"), "left")
    return joined.withColumn(
        out, F.coalesce("_lk_label", named, waiting, formula, F.lit(NO_LABEL))
    ).drop("_lk_id", "_lk_label")
