"""Connected components by alternating large-star and small-star steps, one written table per round."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import discard, materialize


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Every node hands the least node it knows to its larger (or, for ``small``, lesser) neighbours.

    ``edges`` are (a, b) with a > b. The least neighbour is an aggregate with map-side combine, joined
    back to the edges, so a node with very many neighbours never sits in one task unsplit."""
    if small:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("v"))  # for node b, neighbour a is larger
    return larger.join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _mark(edges: DataFrame):
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge and is not its component's least node.

    ``edges``: columns a and b, comparable, in any direction; loops and repeats do no harm. A null end
    drops the edge. No edges give no rows."""
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _mark(now)
    while seen[0]:
        last, now = now, materialize(_star(_star(now, small=False), small=True), "edges")
        discard(last)
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
