"""Texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, exactly.

The search is a prefix filter with positions. Shingles have one order for all texts, those that a sample
shows to be frequent last; a wrong guess there costs time and changes no result. Of two similar sets the
smaller, of m shingles, has the first common one among its first m / 9, the larger, of n, among its
first n / 5; so texts are indexed by the short prefix and looked up by the long one. What lies behind
the two positions bounds the common shingles: a template whose texts share most shingles, but not enough
of them, gives no candidates. Candidates must then agree in parity maps of the sets, a short one and one of
a bit a shingle: each bit that differs stands for a shingle that differs, so none that is similar is lost. Only
those left over are confirmed by counting common shingles.

A shingle of many texts emits no square of pairs while its texts are alike: each text is compared with
the least and the greatest text of the shingle, then, where that leaves different classes, with two more
that differ from shingle to shingle. Only shingles whose texts are still in different classes are compared
text by text, across classes, within reach of size and position. Classes equal those of all pairs.

Words are those of the fingerprint (ASCII white space, A-Z folded); a text of fewer than five words is
one shingle. Texts without words have no shingles and no links. An empty table gives no links.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize, temporary
from .common import map_arrow
from .components import components

SHINGLE = 5
SEED = 42
SAMPLE = 4_000_000  # shingles looked at for the order
HEAVY = 500_000     # frequent shingles that the order knows
MAP = 256           # bits of the parity map that candidates are tried by first
BROADCAST = 500_000  # pairs whose text hashes, 8 bytes each, are broadcast; more are joined by a shuffle
KNOWN_WORDS = 150_000
ROWS = 1024  # texts whose sets a task holds at once
FACTOR = np.uint64(0x9E3779B97F4A7C15)

_known: dict[bytes, int] = {}


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes; those of words met before are kept, for a bounded number of words."""
    if len(_known) > KNOWN_WORDS:
        _known.clear()
    for w in set(words).difference(_known):
        _known[w] = xxhash.xxh64_intdigest(w, SEED)
    return np.fromiter(map(_known.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, dtype=np.int64)
    each, shingle = _word_hashes(words), min(shingle, len(words))
    mixed = np.full(len(words) - shingle + 1, shingle, dtype=np.uint64)
    for k in range(shingle):
        mixed = (mixed ^ each[k:len(each) - shingle + k + 1]) * FACTOR
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed.view(np.int64))


def parity(hashes: np.ndarray, bits: int = MAP) -> np.ndarray:
    """Bit b of the map is the parity of the number of shingles that fall on it."""
    odd = np.bincount((hashes.view(np.uint64) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide(hashes: np.ndarray) -> np.ndarray:
    """A map of as many bits as the set has shingles, in powers of two; its halves fold into the next smaller one."""
    return parity(hashes, max(MAP, 1 << max(0, len(hashes) - 1).bit_length()))


def prefix(hashes: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """The shingles of which a similar text must share one; ``heavy`` is sorted and comes last."""
    n = len(hashes)
    if not n:
        return hashes
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, hashes), len(heavy) - 1)
        known = heavy[at] == hashes
        hashes = np.concatenate((hashes[~known], hashes[known]))
    return hashes[:n - (4 * n + 4) // 5 + 1]


def _sets(texts: DataFrame, made, out: str, maps: bool = False) -> DataFrame:
    """(th, n, ``out``) of rows (th, t): the number of shingles and those that ``made`` picks; with ``maps`` the parity maps too."""
    names = ["th", "n", out, "m", "w"] if maps else ["th", "n", out]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            sets = [shingle_set(x.as_py()) for x in b.column(1)]
            columns = [b.column(0), pa.array([len(s) for s in sets], type=pa.int32()), pa.array([made(s) for s in sets], type=pa.list_(pa.int64()))]
            if maps:
                columns += [pa.array([f(s) for s in sets], type=pa.list_(pa.int64())) for f in (parity, wide)]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        _known.clear()  # the worker goes on to other stages

    return map_arrow(texts, of, f"th long, n int, {out} array<long>" + ", m array<long>, w array<long>" * maps)


def _frequent(texts: DataFrame) -> np.ndarray:
    """Shingles that a sample of the texts, drawn by hash, holds often."""
    size = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    every = max(1, -(-size // (6 * SAMPLE)))
    sample = texts.where(F.pmod(F.xxhash64("th"), F.lit(every)) == 0).dropDuplicates(["th"])
    counts = (_sets(sample, lambda s: s, "s").select(F.explode("s").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("c"))
              .where(F.col("c") >= max(3, 10 // every)))
    top = counts.orderBy(F.desc("c"), "token").limit(HEAVY).select("token").toArrow().column(0).to_numpy()
    return np.sort(top)


def _indexed(n: Column, pos: Column) -> Column:
    """Whether the shingle at ``pos`` is one by which a text of ``n`` is found as the smaller of two."""
    return 9 * (n - pos) >= 8 * n


def _reach(x: str, y: str) -> Column:
    """Whether texts that meet at such positions can be similar enough; the smaller one must be indexed there."""
    n, m, i, j = (F.col(c) for c in (f"{x}.n", f"{y}.n", f"{x}.pos", f"{y}.pos"))
    return ((5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * F.least(n - i, m - j) >= 4 * (n + m))
            & F.when(n < m, _indexed(n, i)).when(m < n, _indexed(m, j)).otherwise(_indexed(n, i) | _indexed(m, j)))


def _agree(n: Column, m: Column, a: Column, b: Column) -> Column:
    """Whether parity maps leave room for the similarity."""
    differing = sum((F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(1, MAP // 64)),
                    F.bit_count(F.get(a, F.lit(0)).bitwiseXOR(F.get(b, F.lit(0)))))
    return 9 * differing <= n + m


def _agree_wide(n: Column, m: Column, a: Column, b: Column) -> Column:
    """The same by wide maps, the wider of which is folded; texts of such sizes have widths equal or next to each other."""
    def fold(x: Column, other: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        halves = F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > F.size(other), halves).otherwise(x)

    each = F.zip_with(fold(a, b), fold(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return 9 * F.aggregate(each, F.lit(0), lambda total, x: total + x) <= n + m


def _confirmed(pairs: DataFrame, texts: DataFrame, found: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of text hashes that are similar enough; only pairs that agree in their wide maps are counted out."""
    left, right = (found.select(F.col("th").alias(x), F.col("n").alias(f"n{x}"), F.col("w").alias(f"w{x}")) for x in "ab")
    pairs = materialize(pairs.join(left, "a").join(right, "b").where(_agree_wide(F.col("na"), F.col("nb"), F.col("wa"), F.col("wb"))).select("a", "b"), "agreeing-pairs")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("th")).distinct()
    if pairs.count() <= BROADCAST:  # so the texts need not be shuffled for it
        asked = F.broadcast(asked)
    sets = materialize(_sets(texts.join(asked, "th", "left_semi").dropDuplicates(["th"]), lambda s: s, "s"), "shingle-sets")
    left, right = (sets.select(F.col("th").alias(x), F.col("n").alias(f"n{x}"), F.col("s").alias(f"s{x}")) for x in "ab")
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(right, "b").join(left, "a").where(9 * common >= 4 * (F.col("na") + F.col("nb"))).select("a", "b")


def links(docs: DataFrame, text: str = "text") -> DataFrame:
    """Edges (a, b) between text hashes; they connect all texts that chains of similar texts connect."""
    with temporary(docs.sparkSession) as keep:
        return keep(_links(docs, text))


def _links(docs: DataFrame, text: str) -> DataFrame:
    texts = docs.select(F.xxhash64(text).alias("th"), F.col(text).cast("binary").alias("t")).where(F.col("t").isNotNull())
    heavy = texts.sparkSession.sparkContext.broadcast(_frequent(texts))
    found = materialize(_sets(texts, lambda s: prefix(s, heavy.value), "p", maps=True).where("n > 0").dropDuplicates(["th"]), "prefixes")
    maps = found.select("th", "m")
    rows = found.select("th", "n", F.posexplode("p").alias("pos", "token"))
    # One number a row is shuffled for the counts: texts, and in the upper half those that are indexed.
    upper = F.lit(1 << 32).cast("bigint")
    counts = rows.groupBy("token").agg(F.sum(F.when(_indexed(F.col("n"), F.col("pos")), upper + 1).otherwise(F.lit(1).cast("bigint"))).alias("s"))
    shared = counts.where((F.col("s") > upper) & (F.col("s").bitwiseAND(upper - 1) > 1)).select("token", F.col("s").bitwiseAND(upper - 1).alias("c"))
    met = materialize(rows.join(shared, "token"), "shared-shingles")
    end = F.struct("th", "n", "pos")
    ends = met.groupBy("token").agg(F.min(end).alias("lo"), F.max(end).alias("hi"))

    def mapped(pairs: DataFrame) -> DataFrame:
        a, b = (maps.select(F.col("th").alias(x), F.col("m").alias(f"m{x}")) for x in "ab")
        return pairs.join(a, "a").join(b, "b").where(_agree(F.col("n"), F.col("m"), F.col("ma"), F.col("mb"))).select("a", "b")

    me = met.join(ends, "token").select(F.struct("th", "n", "pos").alias("me"), F.explode(F.array("lo", "hi")).alias("end"))
    star = (me.where((F.col("me.th") != F.col("end.th")) & _reach("me", "end"))
            .select(F.least("me.th", "end.th").alias("a"), F.greatest("me.th", "end.th").alias("b"), F.col("me.n").alias("n"), F.col("end.n").alias("m"))
            .dropDuplicates(["a", "b"]))
    asked = materialize(mapped(star), "star-pairs")
    known = materialize(_confirmed(asked, texts, found), "links")
    for every_pair in (False, True):
        crowd = _open(met, known, maps)
        if crowd.isEmpty():
            break
        pairs = (_across(crowd) if every_pair else _pivots(crowd)).join(asked, ["a", "b"], "left_anti")  # not compared before
        pairs = materialize(pairs, "more-pairs")
        known, asked = materialize(known.unionByName(_confirmed(pairs, texts, found)), "links"), asked.unionByName(pairs)
    return known


def _open(met: DataFrame, known: DataFrame, maps: DataFrame) -> DataFrame:
    """Rows of shingles of more than three texts (fewer are compared already) that are not all in one class."""
    roots = components(known).withColumnRenamed("node", "th")
    crowd = met.where("c > 3").select("token", "th", "n", "pos").join(roots, "th", "left").withColumn("root", F.coalesce("root", "th"))
    open_ = crowd.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    return materialize(crowd.join(open_.select("token"), "token", "left_semi").join(maps, "th"), "open-shingles")


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(f"{x}.th", f"{y}.th").alias("a"), F.greatest(f"{x}.th", f"{y}.th").alias("b")]


def _likely(x: str, y: str) -> Column:
    """Of different classes, within reach, and agreeing in their maps."""
    n, m, p, q = (F.col(c) for c in (f"{x}.n", f"{y}.n", f"{x}.m", f"{y}.m"))
    return (F.col(f"{x}.root") != F.col(f"{y}.root")) & _agree(n, m, p, q) & _reach(x, y)


def _pivots(crowd: DataFrame) -> DataFrame:
    """Each text with two texts of each of its shingles, others for each shingle: a wide family is joined by many of them."""
    row, order = F.struct("th", "n", "pos", "root", "m"), F.xxhash64("th", "token")
    ends = crowd.groupBy("token").agg(F.min_by(row, order).alias("lo"), F.max_by(row, order).alias("hi"))
    met = crowd.join(ends, "token").select(row.alias("x"), F.explode(F.array("lo", "hi")).alias("y"))
    return met.where(_likely("x", "y")).select(*_pair("x", "y")).distinct()


def _across(crowd: DataFrame) -> DataFrame:
    """All pairs of different classes; a text finds those of its size or less in its own band of sizes or the one below."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("int")
    y = crowd.where(_indexed(F.col("n"), F.col("pos"))).withColumn("band", band).alias("y")
    x = crowd.withColumn("band", F.explode(F.array(band, band - 1))).alias("x")
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.band") == F.col("y.band")) & (F.col("y.n") <= F.col("x.n")) & _likely("x", "y"))
    return met.select(*_pair("x", "y")).distinct()
