"""Importance resampling: documents drawn by how much their word n-grams look like a target's.

Words and pairs of neighbouring words are hashed into buckets. A bucket's gain is the log ratio of its
smoothed frequencies in the target and in the corpus; a document's weight is the mean gain of its
features. Gumbel noise that depends on the id alone turns the largest scores into a draw without
replacement, repeatable at any partitioning.

Arrow kernels lower, split, flatten and dictionary-encode the words of a slice of texts of bounded size.
Shifted dictionary indices form the pairs; the CRC-32 of a pair is put together from those of its words,
for distinct pairs only; ``take`` brings gains back to the positions and a segmented sum to the texts.
Two scans: one for the bucket counts of all texts, which tasks sum before the shuffle, one for weights.
What reaches the driver is one number per bucket. Ranks come from counts per score, so no task sees
all documents: a score's own rows are ordered, and the noise spreads equal weights over many scores.

Null and empty texts have no features: weight 0, never drawn as they have too few words. Null ids draw
the noise of an empty id and lose ties. Ties go to the smaller id. Repeated rows are each counted, scored
and ranked. An empty table gives an empty result; an empty target gives gains from the corpus alone.
Columns besides ``id`` and ``text`` are ignored.
"""
from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .common import crc32_sql, crc32_table_sql, map_arrow

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
PERCENT = 25
MIN_WORDS = 20
SEED = "7"
SLICE = 8_000_000  # bytes of text handled at once; a longer text is a slice of its own
COARSE = 1024      # scores whose counts are summed first


def slices(texts: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """(first, count) of consecutive rows of about ``size`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield at, end - at
        at = end


class Shift:
    """What appending n bytes does to a CRC-32, as lookup tables for powers of two of n."""

    def __init__(self):
        one = [[zlib.crc32(b"\0", 0xFFFFFFFF ^ (v << 8 * k)) ^ 0xFFFFFFFF for v in range(256)] for k in range(4)]
        self.tables = [np.array(one, dtype=np.uint32)]

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        crc = crc.copy()
        for bit in range(int(n.max()).bit_length() if len(n) else 0):
            if bit == len(self.tables):
                self.tables.append(self._apply(self.tables[-1], self.tables[-1]))
            on = (n >> bit & 1).astype(bool)
            crc[on] = self._apply(self.tables[bit], crc[on])
        return crc


class Features:
    """Buckets of the words and pairs of a slice of texts, by distinct word and distinct pair."""

    def __init__(self, texts: pa.Array, buckets: int, shift: Shift):
        parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=SEPARATORS)
        owner, words = pc.list_parent_indices(parts), pc.list_flatten(parts)
        real = pc.not_equal(words, "")
        coded = words.filter(real).dictionary_encode()
        self.owner = owner.filter(real).to_numpy()
        self.word = coded.indices.to_numpy().astype(np.int64)
        known = coded.dictionary.cast(pa.binary()).to_pylist()
        crc = np.fromiter(map(zlib.crc32, known), dtype=np.uint32, count=len(known))
        spaced = np.fromiter((zlib.crc32(b" ", int(c)) for c in crc), dtype=np.uint32, count=len(known))
        size = np.fromiter(map(len, known), dtype=np.int64, count=len(known))
        self.word_bucket = crc % buckets
        self.second = np.flatnonzero(self.owner[1:] == self.owner[:-1]) + 1  # positions that end a pair
        pairs = pa.array(self.word[self.second - 1] * max(1, len(known)) + self.word[self.second]).dictionary_encode()
        self.pair = pairs.indices.to_numpy()
        left, right = np.divmod(pairs.dictionary.to_numpy(), max(1, len(known)))
        self.pair_bucket = (shift(spaced[left], size[right]) ^ crc[right]) % buckets

    def counts(self, buckets: int) -> np.ndarray:
        out = np.bincount(self.word_bucket[self.word], minlength=buckets)
        return out + np.bincount(self.pair_bucket[self.pair], minlength=buckets)

    def sums(self, gains: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """(words, summed gains of all features) of each text."""
        each = gains[self.word_bucket].take(self.word)
        each[self.second] += gains[self.pair_bucket].take(self.pair)
        n = np.bincount(self.owner, minlength=texts)
        total = np.zeros(texts, dtype=np.int64)
        starts = np.flatnonzero(np.diff(self.owner, prepend=-1))
        if len(starts):
            total[self.owner[starts]] = np.add.reduceat(each, starts)
        return n, total


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket: each task sums its own, one row per bucket and task is shuffled."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, shift = np.zeros(buckets, dtype=np.int64), Shift()
        for b in batches:
            for at, n in slices(b.column(0)):
                total += Features(b.column(0).slice(at, n), buckets, shift).counts(buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    summed = map_arrow(texts.select(F.col(text).cast("string").alias("t")), of, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = summed.toArrow()  # one row a bucket
    out = np.zeros(buckets, dtype=np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths of a nat, floored; every count is raised by one."""
    k = len(corpus)
    s_all, t_all = float(corpus.sum() + k), float(target.sum() + k)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(corpus.tolist(), target.tolist())],
                    dtype=np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) per document."""
    kind = docs.schema[id_col].dataType.simpleString()
    buckets, shared = len(gain), docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = Shift()
        for b in batches:
            for at, rows in slices(b.column(1)):
                n, total = Features(b.column(1).slice(at, rows), buckets, shift).sums(shared.value, rows)
                features = np.maximum(2 * n - 1, 0)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, rows), *map(pa.array, (n, features, total // np.maximum(features, 1)))],
                                                 names=["doc_id", "n_words", "n_features", "weight"])

    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("t"))
    return map_arrow(given, of, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(id_col: str = "doc_id", seed: str = SEED):
    """Floored thousandths of a Gumbel variate that the id determines."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def draw(scored: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``rank`` of the highest scores among eligible rows, ``percent`` of them floored; null elsewhere.

    ``scored``: doc_id, score, eligible. Counts per score give the number of rows before each; a window
    orders the rows of one score only."""
    by_score = scored.where("eligible").groupBy("score").agg(F.count(F.lit(1)).alias("c")).withColumn("coarse", F.floor(F.col("score") / COARSE))
    before = (Window.unboundedPreceding, -1)
    coarse = by_score.groupBy("coarse").agg(F.sum("c").alias("c"))  # scores are bounded, so a few hundred rows
    start = coarse.select("coarse", F.coalesce(F.sum("c").over(Window.orderBy(F.desc("coarse")).rowsBetween(*before)), F.lit(0)).alias("start"),
                          F.expr(f"sum(c) over () * {percent} div 100").alias("drawn"))
    inner = Window.partitionBy("coarse").orderBy(F.desc("score")).rowsBetween(*before)
    placed = by_score.withColumn("inner", F.coalesce(F.sum("c").over(inner), F.lit(0))).join(start, "coarse").select(
        "score", (F.col("start") + F.col("inner")).alias("above"), "drawn")
    placed = materialize(placed.where("above < drawn"), "scores-drawn")
    high = scored.where("eligible").join(placed, "score")
    own = F.row_number().over(Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id")))
    ranked = high.withColumn("rank", F.col("above") + own).withColumn("rank", F.when(F.col("rank") <= F.col("drawn"), F.col("rank")).cast("bigint"))
    low = (scored.join(placed.select("score", F.lit(True).alias("high")), "score", "left")
           .where(~F.col("eligible") | F.col("high").isNull()).withColumn("rank", F.lit(None).cast("bigint")))
    return ranked.select(*scored.columns, "rank").unionByName(low.select(*scored.columns, "rank"))


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text",
              buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank per document."""
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    scored = weighed(docs, gain, id_col, text).withColumn("score", F.col("weight") + gumbel("doc_id", seed)).withColumn("eligible", F.col("n_words") >= min_words)
    return draw(materialize(scored, "importance"), percent).drop("eligible")


SQL = rf"""
with crc_table as ({crc32_table_sql()}),
texts as (select 0 as target, doc_id, text from documents union all select 1, null, text from benchmark),
w as (select target, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from texts),
e as (select target, doc_id, unnest(list_concat(ws, list_transform(list_zip(ws[:-2], ws[2:]), lambda p: p[1] || ' ' || p[2]))) as feature from w),
c as (select target, doc_id, feature, count(*) as n from e group by all),
b as (select feature, {crc32_sql('feature')} % {BUCKETS} as bucket from (select distinct feature from c), crc_table),
h as (select target, bucket, sum(n) as n from c join b using (feature) group by all),
g as (select r.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * (select coalesce(sum(n), 0) + {BUCKETS} from h where target = 0)
  / ((coalesce(s.n, 0) + 1)::double * (select coalesce(sum(n), 0) + {BUCKETS} from h where target = 1))))::bigint as gain
  from (select unnest(range({BUCKETS})) as bucket) r left join (from h where target = 0) s using (bucket) left join (from h where target = 1) t using (bucket)),
m as (select doc_id, sum(n) as n_features, sum(n * gain) as total from c join b using (feature) join g using (bucket) where target = 0 group by doc_id),
d as (select w.doc_id, len(ws) as n_words, coalesce(m.n_features, 0)::bigint as n_features, coalesce(floor(total / m.n_features), 0)::bigint as weight,
  ('0x' || substr(sha256('{SEED}:' || w.doc_id), 1, 8))::bigint as h from w left join m using (doc_id) where target = 0),
s as (select *, (weight + floor(-1000 * ln(-ln((h + 0.5)::double / 4294967296))))::bigint as score, n_words >= {MIN_WORDS} as eligible from d),
k as (select *, row_number() over (partition by eligible order by score desc, doc_id) as place, count(*) filter (where eligible) over () as total from s)
select doc_id, n_features, weight, score, case when eligible and place <= {PERCENT} * total // 100 then place end as rank from k
"""
