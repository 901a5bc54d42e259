"""Language identification by interpolated Kneser-Ney character models.

Words are read character by character, each given the three before it in the same word. Four-gram
counts per language cover every training text and are summed by Spark; continuation counts, discounts
and context weights of all orders are derived from them there and written, whole. Probabilities of
four-grams follow from these tables by joins, order by order (``Trained.probabilities``).

Tasks score texts with a sorted array of 64-bit keys (four 16-bit characters, a perfect hash) and a log
probability for each language: as many of the most frequent grams as ``CELLS`` allows. A gram outside it
(rare, or never seen in training) is not guessed: the task hands it on, its probability comes from the same
joins, and it is added to the text's sum. So every gram counts as the full model has it, whatever the size of
the array. A text gets the language with the least cross-entropy per character; it is also marked as
rejected if that is beyond what training texts of that language show (mean plus four deviations).

Letters above U+FFFF share the 8,448 codes from U+D800 to U+F8FF, which hold no letters, by remainder:
those of one script stay apart but for rare ideographs.

Null texts and texts without a letter are ``und`` with score 0. Rows with a null id may train. Ties go to the first language by name.
Without training rows every text is ``und``. Repeated rows are judged alike, one row out for each row
in. An empty table gives an empty result. Columns besides id, text and lang are ignored.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .common import map_arrow
from .quality import held_out

ORDER = 4
CELLS = 20_000_000  # grams times languages that a task holds; the others are joined
SHARPNESS = 4.0
DEVIATIONS = 4.0
START, END = "\x01", "\x02"
FLUSH_WORDS = 200_000
CACHE_WORDS = 300_000
WORD = regex.compile(r"\p{L}+")
MASKS = {k: (1 << 16 * k) - 1 for k in range(1, ORDER)}


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, word number) of every character of the words and of their ends, given the three before."""
    joined = "".join([START * 3 + w + END for w in words])
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    high = codes > 0xFFFF
    codes[high] = 0xD800 + codes[high] % (0xF900 - 0xD800)
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 4)
    if len(codes) < ORDER:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    keys = (codes[:-3] << np.uint64(48)) | (codes[1:-2] << np.uint64(32)) | (codes[2:-1] << np.uint64(16)) | codes[3:]
    real = codes[3:] != 1
    return keys[real], owner[3:][real]


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over all rows given."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for name, words in held.items():
                keys, owner = word_grams(list(words))
                if not len(keys):
                    continue
                grams, at = np.unique(keys, return_inverse=True)
                n = np.bincount(at, weights=np.fromiter(words.values(), dtype=np.float64)[owner]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array(grams.view(np.int64)), pa.array(n)],
                                                 names=["lang", "gram", "n"])
            held.clear()

        for b in batches:
            for t, name in zip(b.column(0), b.column(1)):
                held.setdefault(name.as_py(), Counter()).update(words_of(t.as_py()))
                if sum(map(len, held.values())) > FLUSH_WORDS:
                    yield from flush()
        yield from flush()

    given = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("t"), F.col(lang).cast("string").alias("lang"))
    summed = map_arrow(given, of, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return materialize(summed, "grams")


@dataclass(frozen=True)
class Trained:
    """The whole model: per order the discounted shares of grams (lang, gram, share) and the weights that contexts leave
    to the order below (lang, ctx, weight)."""

    langs: list[str]
    counts: DataFrame
    shares: dict[int, DataFrame]
    weights: dict[int, DataFrame]
    floor: float  # of a character below the lowest order

    def probabilities(self, wanted: DataFrame) -> DataFrame:
        """(gram, logp): log probabilities by language of the distinct four-grams in ``wanted``, interpolated from the lowest order up."""
        every = F.explode(F.array(*[F.lit(x) for x in self.langs])).alias("lang")
        p = None
        for k in range(1, ORDER + 1):
            own = wanted if k == ORDER else wanted.select(F.col("gram").bitwiseAND(F.lit(MASKS[k]).cast("bigint")).alias("gram")).distinct()
            rows = own.select("gram", every).withColumn("ctx", F.call_function("shiftrightunsigned", F.col("gram"), F.lit(16)))
            rows = rows.join(self.shares[k], ["lang", "gram"], "left").join(self.weights[k], ["lang", "ctx"], "left")
            below = F.lit(self.floor)
            if p is not None:
                rows = rows.withColumn("low", F.col("gram").bitwiseAND(F.lit(MASKS[k - 1]).cast("bigint"))).join(
                    p.withColumnsRenamed({"gram": "low", "p": "below"}), ["lang", "low"])
                below = F.col("below")
            p = rows.select("lang", "gram", (F.coalesce("share", F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * below).alias("p"))
        listed = p.groupBy("gram").agg(F.array_sort(F.collect_list(F.struct("lang", "p"))).alias("x"))  # an entry a language
        return listed.select("gram", F.transform("x", lambda e: F.log(e["p"])).alias("logp"))

    def frequent(self, cells: int = CELLS) -> "Models":
        """The most frequent grams, as many as fit, cut at a power of two of their count."""
        n = self.counts.groupBy("gram").agg(F.sum("n").alias("n"))
        band = F.floor(F.log2("n")).cast("int")
        room, least = cells // max(1, len(self.langs)), 0
        for r in sorted(n.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("c")).collect(), key=lambda r: -r["band"]):  # at most 64 rows
            room -= r["c"]
            if room < 0:
                least = r["band"] + 1
                break
        known = self.probabilities(n.where(band >= least).select("gram")).toArrow()
        keys = known.column("gram").to_numpy().view(np.uint64)
        table = pa.concat_arrays(known.column("logp").chunks or [pa.array([], pa.list_(pa.float64()))]).flatten().to_numpy().reshape(len(keys), len(self.langs))
        order = np.argsort(keys)
        return Models(self.langs, keys[order], table[order].astype(np.float32))


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Trained:
    """Counts and models of every language of the rows given."""
    counts = gram_counts(docs, text, lang)
    shares, weights, now = {}, {}, counts
    for k in range(ORDER, 0, -1):
        ones, twos = F.count(F.when(F.col("n") == 1, 1)), F.count(F.when(F.col("n") == 2, 1))
        discount = now.groupBy("lang").agg(F.coalesce(F.greatest(F.try_divide(ones, ones + 2 * twos), F.lit(0.1)), F.lit(0.5)).alias("d"))
        ctx = F.call_function("shiftrightunsigned", F.col("gram"), F.lit(16)).alias("ctx")
        totals = (now.groupBy("lang", ctx).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
                  .join(F.broadcast(discount), "lang"))  # a row a language
        totals = materialize(totals, "contexts")
        weights[k] = totals.select("lang", "ctx", (F.col("d") * F.col("types") / F.col("total")).alias("weight"))
        share = F.greatest((F.col("n") - F.col("d")) / F.col("total"), F.lit(0.0)).alias("share")
        shares[k] = materialize(now.select("lang", "gram", "n", ctx).join(totals, ["lang", "ctx"]).select("lang", "gram", share), "shares")
        if k > 1:  # below the highest order n counts the different characters that come before
            now = materialize(now.groupBy("lang", F.col("gram").bitwiseAND(F.lit(MASKS[k - 1]).cast("bigint")).alias("gram"))
                              .agg(F.count(F.lit(1)).alias("n")), "continuations")
    sizes = shares[1].groupBy("lang").agg(F.count(F.lit(1)).alias("c")).collect()  # a row a language
    return Trained(sorted(r["lang"] for r in sizes), counts, shares, weights, 1.0 / max(64, 2 * sum(r["c"] for r in sizes)))


@dataclass(frozen=True)
class Models:
    """Log probabilities (grams by languages) of some grams, with their sorted keys."""

    langs: list[str]
    keys: np.ndarray
    table: np.ndarray

    def words(self, words: list[str]) -> tuple[np.ndarray, list[list[int]]]:
        """Log probability of each word in each language, without the grams not held, and those grams."""
        keys, owner = word_grams(words)
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        held = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
        each = self.table[at[held]].astype(np.float64)
        sums = np.stack([np.bincount(owner[held], weights=each[:, i], minlength=len(words)) for i in range(len(self.langs))], axis=1)
        rest: list[list[int]] = [[] for _ in words]
        for i, gram in zip(owner[~held].tolist(), keys[~held].view(np.int64).tolist()):
            rest[i].append(gram)
        return sums, rest


class Scorer:
    """Sums over texts; those of words met before are kept."""

    def __init__(self, models: Models):
        self.models, self.known = models, {}

    def sums(self, text: str | None) -> tuple[int, np.ndarray, Counter] | None:
        """Characters, log probability by language, and grams still to be added; None without a letter."""
        words = words_of(text)
        if not words or not self.models.langs:
            return None
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            if len(self.known) + len(new) > CACHE_WORDS:
                self.known = {}
                new = list(dict.fromkeys(words))
            self.known.update(zip(new, zip(*self.models.words(new))))
        found = [self.known[w] for w in words]
        return sum(map(len, words)) + len(words), np.array([s for s, _ in found]).sum(axis=0), Counter(g for _, rest in found for g in rest)


def identified(docs: DataFrame, trained: Trained, id_col: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), cells: int = CELLS) -> DataFrame:
    """doc_id, ``keep`` columns, lang_pred, score, entropy (null for und) per document."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(trained.frequent(cells))  # bounded by ``cells``
    kept = [docs.schema[c] for c in keep]
    names = ["doc_id", *keep, "row", "size", "sums", "rest"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        task = TaskContext.get()
        row = (task.partitionId() if task else 0) << 40
        for b in batches:
            found = [scorer.sums(t.as_py()) for t in b.column(b.num_columns - 1)]
            rows = pa.array(np.arange(row, row + len(found), dtype=np.int64))
            row += len(found)
            rest = [sorted(x[2].items()) if x and x[2] else None for x in found]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], rows, pa.array([x and x[0] for x in found], pa.int64()), pa.array([x and x[1] for x in found], pa.list_(pa.float64())),
                 pa.array([x and [{"gram": g, "n": n} for g, n in x] for x in rest], pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())])))], names=names)

    given = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text).alias("__text"))
    types = [f"doc_id {kind}", *[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "row long", "size long", "sums array<double>",
             "rest array<struct<gram:long,n:long>>"]
    base = materialize(map_arrow(given, of, ", ".join(types)), "text-sums")
    return _judged(base, trained).select("doc_id", *keep, "lang_pred", "score", "entropy")


def _judged(base: DataFrame, trained: Trained) -> DataFrame:
    """Languages from the sums, with the grams that tasks did not hold."""
    n = len(trained.langs)
    if not n:
        return base.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "entropy": F.lit(None).cast("double")})
    rest = base.select("row", F.inline("rest"))
    logp = trained.probabilities(rest.select("gram").distinct())
    more = rest.join(logp, "gram").groupBy("row").agg(F.array(*[F.sum(F.col("n") * F.get("logp", F.lit(i))) for i in range(n)]).alias("more"))
    whole = base.join(more, "row", "left").withColumn("h", F.transform(
        F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda a, b: a + b)), lambda x: -x / F.col("size")))
    least = F.array_min("h")
    near = F.aggregate("h", F.lit(0.0), lambda acc, x: acc + F.exp(-SHARPNESS * (x - least)))
    name = F.element_at(F.array(*[F.lit(x) for x in trained.langs]), F.array_position("h", least).cast("int"))
    return whole.withColumns({"lang_pred": F.when(F.col("h").isNull(), "und").otherwise(name), "score": F.when(F.col("h").isNull(), 0.0).otherwise(1 / near), "entropy": least})


def predicted(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", cells: int = CELLS) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected per document; learns from rows that are not held out."""
    out: Column = held_out(id_col, 4, 2)
    row = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), out.alias("held_out"))
    trained = train(row.where("not held_out"))
    found = materialize(identified(row, trained, "doc_id", "text", ("held_out", "lang"), cells), "languages")
    usual = (found.where("not held_out and lang = lang_pred").groupBy("lang_pred")
             .agg((F.avg("entropy") + DEVIATIONS * F.stddev_pop("entropy")).alias("limit")))
    return found.join(F.broadcast(usual), "lang_pred", "left").select(  # a row a language
        "doc_id", "held_out", "lang_pred", "score", F.coalesce(F.col("entropy") > F.col("limit"), F.lit(True)).alias("rejected"))
