"""Most frequent values of many columns: candidates from a mergeable sketch, then exact counts of those alone.

Each task keeps a frequent-items sketch per column, of a fixed number of counters; sketches merge. The
values it reports are counted exactly in a second scan, map-side, so what is shuffled depends on the
number of tasks and candidates and not on the number of distinct values. A column's list is proven
right when its last count exceeds what any value outside the candidates can have: the sketch's error, or
the rows that the candidates leave over. Columns without that proof (nearly unique or evenly spread ones)
are counted in full, and only those.

Blank values are no values. Ties go to the lesser value. A column without values has no rows.
"""
from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import nonblank, qcol
from .series import top_per_group

TRACKED = 8192  # counters of a sketch
SPARE = 8       # candidates asked for, in multiples of k


def columns_of(names) -> dict[str, Column]:
    """Non-blank values of columns as text, by column name."""
    return {c: F.when(nonblank(c), qcol(c).cast("string")) for c in names}


def _error(rows: Column, tracked: int) -> Column:
    """What a value that the sketch does not report may count: twice its error bound of 3.5 / slots."""
    return rows * (2 * 3.5 / 2 ** math.ceil(math.log2(tracked / 0.75)))


def candidates(df: DataFrame, items: Mapping[str, Column], k: int, tracked: int = TRACKED) -> DataFrame:
    """(name, populated, bound, values) per item: likely frequent values and a bound on the count of any other, from one scan."""
    asked = min(tracked, SPARE * max(k, 8))
    aggs = [F.count(F.lit(1)).alias("rows")]  # the sketch counts blanks too
    for i, c in enumerate(items.values()):
        aggs += [F.count(c).alias(f"n{i}"), F.call_function("approx_top_k", c, F.lit(asked), F.lit(tracked)).alias(f"s{i}")]
    row = df.agg(*aggs)
    shown = []
    for i, name in enumerate(items):
        s, n = F.filter(f"s{i}", lambda x: x["item"].isNotNull()), F.col(f"n{i}")
        least = F.when(F.size(f"s{i}") >= asked, F.array_min(F.transform(f"s{i}", lambda x: x["count"]))).otherwise(0)
        shown.append(F.struct(F.lit(name).alias("name"), n.alias("populated"), F.greatest(_error(F.col("rows"), tracked), least).alias("bound"),
                              F.transform(s, lambda x: x["item"]).alias("values")))
    return row.select(F.inline(F.array(*shown)))


def _tagged(df: DataFrame, items: Mapping[str, Column]) -> DataFrame:
    """(name, value) of every populated item of every row."""
    return df.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), c.alias("value")) for n, c in items.items()]))).where("value is not null")


def exact_counts(df: DataFrame, items: Mapping[str, Column]) -> DataFrame:
    return _tagged(df, items).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


def top_items(df: DataFrame, items: Mapping[str, Column], k: int, tracked: int = TRACKED) -> DataFrame:
    """(name, rank, value, n): the ``k`` most frequent values of each item, exactly."""
    if not items:
        return df.select(F.lit("").alias("name"), F.lit(0).alias("rank"), F.lit("").alias("value"), F.lit(0).cast("bigint").alias("n")).limit(0)
    # A row an item, of at most SPARE * k values each: small whatever the table, so the driver may see it.
    found = candidates(df, items, k, tracked).collect()
    known = df.sparkSession.createDataFrame([(r["name"], v) for r in found for v in r["values"]], "name string, value string")
    counted = _tagged(df, items).join(F.broadcast(known), ["name", "value"], "left_semi").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    counts: dict[str, list] = {}
    for x in counted.collect():
        counts.setdefault(x["name"], []).append((-x["n"], x["value"].encode(), x["value"]))
    proven, kept = set(), []
    for r in found:
        own = sorted(counts.get(r["name"], []))
        left = r["populated"] + sum(x[0] for x in own)  # rows that the candidates leave over
        last = -own[k - 1][0] if len(own) >= k else 0
        if not left or last > min(left, r["bound"]):
            proven.add(r["name"])
            kept += [(r["name"], at, value, -n) for at, (n, _, value) in enumerate(own[:k], 1)]
    out = df.sparkSession.createDataFrame(kept, "name string, rank int, value string, n long")
    rest = {n: c for n, c in items.items() if n not in proven}
    if not rest:
        return out
    return out.unionByName(top_per_group(exact_counts(df, rest), "name", k, "n", "value").select("name", "rank", "value", "n"))
