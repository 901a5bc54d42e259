"""Composite identity keys, pseudonyms and per-hit page-view markers."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import as_col, flag, nonblank, pick_col

PAGE_VIEW_BASES = ("all_hits", "page_marker")
NULL_PART = "␀"
# Per-visit page-view buckets and the metric suffix of each.
PV_BUCKETS = {"0": "0", "1": "1", "2": "2", "3-5": "3_5", "6+": "6plus"}


def key_plain(*cols: str | Column) -> Column:
    """Parts joined by '_'; NULL parts vanish (and an all-NULL key is '')."""
    return F.concat_ws("_", *[as_col(c).cast("string") for c in cols])


def key_null_safe(*cols: str | Column) -> Column:
    """NULL parts keep their position; a key of only NULLs is NULL and so not counted."""
    parts = [as_col(c).cast("string") for c in cols]
    key = F.concat_ws("_", *[F.coalesce(p, F.lit(NULL_PART)) for p in parts])
    return F.when(F.coalesce(*parts).isNotNull(), key)


def pseudonymize(c: str | Column, key: str) -> Column:
    """Deterministic keyed SHA-256, so distinct counts survive. NULL stays NULL."""
    return F.sha2(F.concat(F.lit(key), as_col(c).cast("string")), 256)


def page_view_flag(basis: str = "all_hits", marker: str | Column = "post_page_event") -> Column:
    if basis not in PAGE_VIEW_BASES:
        raise ValueError(f"unknown page view basis: {basis!r}")
    return F.lit(1) if basis == "all_hits" else flag(as_col(marker).try_cast("int") == 0)


def page_view_flag_fallback(df: DataFrame) -> tuple[Column, str]:
    """Best available page-view marker of a table, and which one it is."""
    marker = pick_col(df, "post_page_event", "page_event")
    if marker:
        return flag(as_col(marker).try_cast("int") == 0), "page_marker"
    page = pick_col(df, "post_pagename", "pagename")
    if page:
        return flag(nonblank(page)), "pagename"
    return F.lit(1), "all_hits"


WORD = 60  # flags per long


def flag_words(conds: Sequence[Column], prefix: str = "_w") -> list[Column]:
    """Many boolean flags as bits of a few longs, so that they travel as one column each."""
    words = []
    for at in range(0, len(conds), WORD):
        word = F.lit(0).cast("long")
        for bit, cond in enumerate(conds[at:at + WORD]):
            word = word.bitwiseOR(F.when(cond, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
        words.append(word.alias(f"{prefix}{at // WORD}"))
    return words


def or_words(n: int, prefix: str = "_w") -> list[Column]:
    """Group aggregates: a flag is set when any row of the group has it."""
    return [F.bit_or(f"{prefix}{i}").alias(f"{prefix}{i}") for i in range((n + WORD - 1) // WORD)]


def count_flag(i: int, prefix: str = "_w") -> Column:
    """Groups that have flag ``i``."""
    word, bit = divmod(i, WORD)
    return F.sum(F.getbit(f"{prefix}{word}", F.lit(bit)).cast("long"))


def pv_bucket(n: str | Column) -> Column:
    n = as_col(n)
    return (F.when(n == 0, "0").when(n == 1, "1").when(n == 2, "2")
            .when(n <= 5, "3-5").otherwise("6+"))
