"""SimHash near-duplicates with covering locality-sensitive hashing.

Bits are dealt to the non-zero vectors of {0,1}^(r+1); table v keeps the bits whose vector has an odd
product with v. Any r differing bits span less than the whole space, so some v is orthogonal to all of
them and its table gives both fingerprints the same key: no pair within the radius is missed. Buckets
of two are compared directly. Larger buckets emit no pairs: each of their fingerprints lists the 65
points within one bit of it, and two fingerprints are within two bits exactly if they share a point; at
most 65 fingerprints can meet in a point, and each is linked to the least of them, which again is
within two bits. Rows stay in proportion to distinct fingerprints, whatever the size of a group.

``keep_one`` also links texts of a five-word similarity of 0.8 or more (``jaccard``), which lie up to some 13
bits apart and which no radius that keys can cover would find in full.

Copies share a fingerprint and are carried as one node. A text without words (null, empty, blank) has
fingerprint zero and is linked like any other. Repeated rows fall into one class. Null ids are classed
but never name a class unless it has no other id. An empty table gives an empty result. Other columns
are passed through by ``keep_one`` and ignored elsewhere.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize, temporary
from . import jaccard
from .common import map_arrow, row_key
from .components import components

SHINGLE = 3
RADIUS = 2  # the point argument above is for two bits
SEED = 42
BITS = 64
CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of the whole text, lower-cased in A-Z."""
    words = (text or b"").lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist()
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, CHUNK):
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key, fp) per document, written once."""
    kind = docs.schema[id_col].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array((fingerprint(t, shingle) for t in _values(b.column(2))), type=pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fps], names=["doc_id", "key", "fp"])

    given = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text).alias("key"), F.col(text).cast("binary").alias("t"))
    return materialize(map_arrow(given, of, f"doc_id {kind}, key long, fp long"), "fingerprints")


def _values(column: pa.Array) -> Iterator[bytes | None]:
    return (x.as_py() for x in column)


def masks(radius: int = RADIUS) -> list[int]:
    """The bit masks of the covering tables, as signed 64-bit numbers."""
    vectors = (1 << (radius + 1)) - 1
    out = []
    for v in range(1, vectors + 1):
        m = sum(1 << i for i in range(BITS) if ((i % vectors + 1) & v).bit_count() % 2)
        out.append(m - (1 << BITS) if m >> (BITS - 1) else m)
    return out


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints within the radius; they connect all that are."""
    tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("k"))
                                 for t, m in enumerate(masks())]))
    dealt = fps.select("fp", tables.alias("x")).select("fp", "x.t", "x.k")
    buckets = materialize(dealt.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                          .where("n > 1"), "buckets")
    pairs = buckets.where("n = 2").select("a", "b").where(_apart(F.col("a"), F.col("b")) <= RADIUS)
    crowded = dealt.join(buckets.where("n > 2").select("t", "k"), ["t", "k"], "left_semi").select("fp").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.col("fp").bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), i)))
    points = crowded.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("point"))
    met = points.groupBy("point").agg(F.collect_set("fp").alias("m")).where(F.size("m") > 1)  # at most 65 each
    stars = met.select(F.array_min("m").alias("b"), F.explode("m").alias("a")).where("a <> b").select("a", "b")
    return pairs.unionByName(stars).distinct()


def classes(prints: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """(fp, root): the class of each distinct fingerprint, named by its least one; ``more`` are further edges."""
    fps = prints.select("fp").distinct()
    edges = links(fps)
    stars = components(edges if more is None else edges.unionByName(more))
    return fps.join(stars.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex) and component_id (the least doc_id of the class) per document."""
    prints = fingerprints(docs, id_col, text)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    rooted = materialize(classes(prints).join(least, "fp"), "roots")
    named = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_print = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def similar(docs: DataFrame, prints: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Edges (a, b) between fingerprints of texts that share enough five-word shingles."""
    edges = jaccard.links(docs, text)
    ends = edges.select(F.explode(F.array("a", "b")).alias("th")).distinct()
    hashed = docs.select(row_key(id_col, text).alias("key"), F.xxhash64(text).alias("th")).join(ends, "th", "left_semi")
    named = materialize(hashed.join(prints.select("key", "fp"), "key").select("th", "fp").distinct(), "similar-prints")
    a, b = (named.select(F.col("th").alias(x), F.col("fp").alias(f"f{x}")) for x in "ab")
    return edges.join(a, "a").join(b, "b").select(F.col("fa").alias("a"), F.col("fb").alias("b")).distinct()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, the one with the least id (nulls last), all columns as they came.

    Classes are chains of fingerprints within the radius and of texts with a five-word similarity of 0.8."""
    with temporary(docs.sparkSession) as keep:
        prints = fingerprints(docs, id_col, text)
        best = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "key")).alias("best"))
        chosen = (classes(prints, similar(docs, prints, id_col, text)).join(best, "fp").groupBy("root").agg(F.min("best").alias("best"))
                  .select(F.col("best.key").alias("__kept_key")))
        chosen = keep(materialize(chosen, "kept"))
    return (docs.withColumn("__kept_key", row_key(id_col, text)).join(chosen, "__kept_key", "left_semi")
            .dropDuplicates(["__kept_key"]).drop("__kept_key"))
