"""Quality classifier: a Gaussian kernel over document statistics by random Fourier features.

Each text becomes a short vector of statistics, once. Ridge regression on random Fourier features of
the standardised statistics is solved from normal equations that every partition sums for itself; all
labelled training rows count. Isotonic calibration on rows that the regression did not see maps its
output to 0..1. What reaches the driver is a matrix and a histogram of fixed size.

Null and empty texts have all-zero statistics and get a score like any other. Rows without a label
don't train; with no labelled rows, or one class only, every score is the share of label 1 (0.5
without rows). Repeated rows get the same score, one row out for each row in. Null ids are scored and
never train. An empty table gives an empty result. Other columns are ignored, or passed through by ``keep``.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .common import map_arrow

FEATURES = 192
SEED = 20
RIDGE = 1e-3
BINS = 1024
CUT = 0.3
SYMBOLS = b"#$%&*<>@^~=+"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STATISTICS = 20


def statistics(text: str | None) -> list[float]:
    """Shape of a text: lengths, character classes, repetition. Language and content play no part."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * STATISTICS
    data = text.encode("utf-8", "replace")
    size = len(data)

    def share(chars: bytes) -> float:
        return (size - len(data.translate(None, chars))) / n

    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts = Counter(words)
    again = sum(a == b for a, b in zip(words, words[1:])) / n
    lines = text.split("\n")
    trigrams = set(zip(words, words[1:], words[2:]))
    return [
        1.0, float(np.log1p(n)), float(sizes.mean()), float(sizes.std()), float((sizes <= 3).mean()), float((sizes >= 12).mean()),
        share(SYMBOLS), share(b"|"), share(b"!"), share(b"."), share(b","), share(b"0123456789"), share(CAPITALS) / float(sizes.mean()),
        float(np.log1p(len(counts))) / float(np.log1p(n)), max(counts.values()) / n, again,
        len(trigrams) / max(1, n - 2), float(np.log1p(len(lines))), len(set(lines)) / len(lines), share(b"_/\\[]{}()"),
    ]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None  # of the features and a constant; None: ``knots`` say it all
    knots: np.ndarray  # calibrated share of label 1 at the middle of each bin

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        rng = np.random.default_rng(SEED)
        w = rng.standard_normal((x.shape[1], FEATURES)) / np.sqrt(x.shape[1])
        b = rng.uniform(0, 2 * np.pi, FEATURES)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ w + b), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, -0.5, 1.5)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(x):
            return np.full(len(x), float(self.knots[0]))
        raw = self.raw(x)
        level = np.interp(bin_place(raw), np.arange(BINS) + 0.5, self.knots)
        return 0.98 * level + 0.02 * (raw + 0.5) / 2  # the last part keeps the order inside a level


def bin_place(raw: np.ndarray) -> np.ndarray:
    return (raw + 0.5) / 2 * BINS


def isotonic(counts: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Non-decreasing share of label 1 per bin, by pooling adjacent violators; empty bins take their neighbours' line."""
    blocks: list[list[float]] = []  # ones, count, first bin, last bin
    for i in np.flatnonzero(counts):
        blocks.append([float(ones[i]), float(counts[i]), i, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    at, level = [], []
    for o, c, first, last in blocks:
        at += [first, last]
        level += [o / c] * 2
    return np.interp(np.arange(len(counts)), at, level)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), STATISTICS)


def described(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every text, written once."""
    kind = docs.schema[id_col].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([statistics(t.as_py()) for t in b.column(1)], type=pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), x], names=["doc_id", "x"])

    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("t"))
    return materialize(map_arrow(given, of, f"doc_id {kind}, x array<double>"), "statistics")


def held_out(doc_id: Column | str = "doc_id", of: int = 5, rest: int = 0) -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % of == rest, F.lit(False))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Trains on the rows of ``stats`` that have a label; the caller leaves out held-out rows."""
    marked = labels.select("doc_id", F.col(label).cast("double").alias("y")).where(F.col("y").isNotNull()).distinct()
    rows = materialize(stats.join(marked, "doc_id").select(
        "x", "y", (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("calibrates")), "labelled")
    each = [f(F.get("x", F.lit(i))) for i in range(STATISTICS) for f in (F.avg, F.stddev_pop)]
    n, ones, *moments = rows.agg(F.count(F.lit(1)), F.sum("y"), *each).first()
    if not n or not 0 < ones < n:
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS), None, np.full(BINS, ones / n if n else 0.5))
    mean, spread = np.array(moments[::2], dtype=float), np.array(moments[1::2], dtype=float)
    model = Model(mean, np.where(spread > 1e-9, spread, 1.0), None, np.zeros(BINS))
    size = FEATURES + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for b in batches:
            z = np.hstack([model.features(_matrix(b.column(0))), b.column(1).to_numpy()[:, None]])
            total += z.T @ z
        i, j = np.triu_indices(size + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "v"])

    trains = rows.where("not calibrates").select("x", "y")
    cells = map_arrow(trains, sums, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # a fixed number
    a = np.zeros((size + 1, size + 1))
    for i, j, v in cells:
        a[i, j] = a[j, i] = v
    model.weights = np.linalg.solve(a[:size, :size] + RIDGE * n * np.eye(size) / size, a[:size, size])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = np.minimum(bin_place(model.raw(_matrix(b.column(0)))), BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), b.column(1)], names=["bin", "y"])

    counts, hits = np.zeros(BINS), np.zeros(BINS)
    seen = map_arrow(rows.where("calibrates").select("x", "y"), placed, "bin long, y double")
    for k, c, o in seen.groupBy("bin").agg(F.count(F.lit(1)), F.sum("y")).collect():  # at most BINS rows
        counts[k], hits[k] = c, o
    if counts.any():
        model.knots = isotonic(counts, hits)
    else:
        model.knots = np.clip((np.arange(BINS) + 0.5) / BINS * 2 - 0.5, 0, 1)
    return model


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    stats = described(docs, id_col, text)
    model = fit(stats.where(~held_out()), labels)
    kind = stats.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_matrix(b.column(1))))], names=["doc_id", "score"])

    out = map_arrow(stats, of, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents scored at the cut or above, all columns as they came."""
    model = fit(described(docs, id_col, text).where(~held_out()), labels)
    place = docs.columns.index(text)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t.as_py()) for t in b.column(place)]).reshape(-1, STATISTICS)
            yield b.filter(pa.array(model.score(x) >= CUT))

    return map_arrow(docs, of, docs.schema)
