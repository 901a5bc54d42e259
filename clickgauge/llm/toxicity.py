"""Toxicity by a small convolutional network.

A word is the sum of two hashed embeddings, of itself and of its first four letters. Filters of one,
two and three words run over the text, the largest answer of each filter is kept, and a linear layer
scores those. Every labelled training row counts. Shards of them, of bounded size and dealt by a hash of the
id, train with Adagrad from a common start, classes weighted alike; then each parameter moves by the mean over
the shards that moved it, in fixed point, so that no order of tasks shows in the result. A fifth of the rows,
which training did not see, maps the output to a probability and sets a threshold for each language, from
counts of all of them by steps of the output. What reaches the driver is the network and those counts, of
fixed size. Scores come from the text alone; language only picks the threshold for ``flagged``.

Null and empty texts have no words and get the network's answer to nothing. With no labelled rows, or
one class only, every score is the share of label 1 (0 without rows). Repeated rows are judged alike,
one row out for each row in. Null ids are scored and never train. An empty table gives an empty result.
Columns besides id, text and lang are ignored.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .common import map_arrow
from .quality import held_out

BUCKETS = 1 << 15
DIM = 12
FILTERS = 12
WIDTHS = (1, 2, 3)
SHARD = 4096  # labelled rows that train in one task before parameters are merged
ROUNDS = 2
EPOCHS = 2  # passes of a shard over its rows in each round
FIXED = 1 << 40  # fixed point of merged parameters
STEPS = 256  # of one unit of the network's output, for calibration and thresholds
REACH = 64 * STEPS
BROADCAST_IDS = 500_000  # more labelled ids are joined by a shuffle
RATE = 0.08
PREFIX = 4
CUT = 0.3
SEED = 6
CACHE_WORDS = 300_000
WORD = regex.compile(r"\p{L}+")


class Encoder:
    """Bucket pairs of words; words met before are kept."""

    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        known, out = self.known, []
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in WORD.findall((text or "").lower()):
            pair = known.get(w)
            if pair is None:
                pair = known[w] = (zlib.crc32(w.encode()) % BUCKETS, zlib.crc32(b"<" + w[:PREFIX].encode()) % BUCKETS)
            out.append(pair)
        return np.array(out, dtype=np.int32).reshape(-1, 2)


@dataclass
class Network:
    embed: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width * DIM, FILTERS)
    out: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def fresh(cls) -> Network:
        rng = np.random.default_rng(SEED)
        return cls(rng.standard_normal((BUCKETS, DIM)) * 0.1,
                   {w: rng.standard_normal((w * DIM, FILTERS)) / np.sqrt(w * DIM) for w in WIDTHS},
                   rng.standard_normal(len(WIDTHS) * FILTERS) * 0.1, 0.0)

    def pooled(self, pairs: np.ndarray):
        """Largest answer of each filter, and where it is; zeros for texts shorter than the filter."""
        e = self.embed[pairs[:, 0]] + self.embed[pairs[:, 1]]
        tops, places = [], []
        for w in WIDTHS:
            n = len(e) - w + 1
            if n < 1:
                tops.append(np.zeros(FILTERS)), places.append(None)
                continue
            f = self.filters[w]
            a = e[:n] @ f[:DIM]
            for i in range(1, w):
                a += e[i:i + n] @ f[i * DIM:(i + 1) * DIM]
            at = a.argmax(axis=0)
            tops.append(a[at, np.arange(FILTERS)]), places.append(at)
        return e, tops, places

    def logit(self, pairs: np.ndarray) -> float:
        _, tops, _ = self.pooled(pairs)
        return float(np.maximum(np.concatenate(tops), 0) @ self.out + self.bias)

    def vectors(self) -> np.ndarray:
        """All parameters that training moves, as rows of DIM numbers: the embeddings, then the rest."""
        rest = np.concatenate([*[self.filters[w].ravel() for w in WIDTHS], self.out, [self.bias]])
        return np.vstack([self.embed, np.pad(rest, (0, -len(rest) % DIM)).reshape(-1, DIM)])

    @classmethod
    def of(cls, vectors: np.ndarray) -> Network:
        rest, filters, at = vectors[BUCKETS:].ravel(), {}, 0
        for w in WIDTHS:
            filters[w] = rest[at:at + w * DIM * FILTERS].reshape(w * DIM, FILTERS).copy()
            at += w * DIM * FILTERS
        n = len(WIDTHS) * FILTERS
        return cls(vectors[:BUCKETS].copy(), filters, rest[at:at + n].copy(), float(rest[at + n]))

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, share: float = 0.5) -> None:
        """Passes over the texts; classes weigh alike if ``share`` of all rows have label 1."""
        rng = np.random.default_rng(SEED)
        ge = np.full(BUCKETS, 1e-3)
        gf = {w: np.full_like(f, 1e-3) for w, f in self.filters.items()}
        go, gb = np.full_like(self.out, 1e-3), 1e-3
        for _ in range(EPOCHS):
            for k in rng.permutation(len(texts)):
                pairs = texts[k]
                e, tops, places = self.pooled(pairs)
                h = np.maximum(np.concatenate(tops), 0)
                d = 1 / (1 + np.exp(-np.clip(h @ self.out + self.bias, -30, 30))) - labels[k]
                d *= 0.5 / (share if labels[k] else 1 - share)
                dh = d * self.out * (h > 0)
                step = d * h
                go += step ** 2
                gb += d * d
                self.out -= RATE * step / np.sqrt(go)
                self.bias -= RATE * d / np.sqrt(gb)
                for j, w in enumerate(WIDTHS):
                    if places[j] is None:
                        continue
                    live = np.flatnonzero(dh[j * FILTERS:(j + 1) * FILTERS])
                    if not len(live):
                        continue
                    g, at = dh[j * FILTERS + live], places[j][live]
                    for i in range(w):
                        part = self.filters[w][i * DIM:(i + 1) * DIM]
                        into = part[:, live].T * g[:, None]  # per live filter, for the embeddings
                        fg = (e[at + i] * g[:, None]).T
                        acc = gf[w][i * DIM:(i + 1) * DIM]
                        acc[:, live] += fg ** 2
                        part[:, live] -= RATE * fg / np.sqrt(acc[:, live])
                        for side in (0, 1):
                            rows = pairs[at + i, side]
                            np.add.at(ge, rows, (into ** 2).mean(axis=1))
                            np.add.at(self.embed, rows, -RATE * into / np.sqrt(ge[rows])[:, None])

    def calibrate(self, logits: np.ndarray, labels: np.ndarray, counts: np.ndarray, share: float) -> None:
        """Logistic fit of the labels on the logits, which occur ``counts`` times, weighted to ``share`` of label 1."""
        ones = np.average(labels, weights=counts)
        weight = counts * np.where(labels == 1, share / max(ones, 1e-9), (1 - share) / max(1 - ones, 1e-9))
        x = np.stack([logits, np.ones_like(logits)], axis=1)
        scale = max(1.0, float(np.abs(logits).max()))
        x[:, 0] /= scale
        t = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ t, -30, 30)))
            grad = x.T @ (weight * (p - labels)) + 1e-2 * t
            hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
            t -= np.linalg.solve(hess, grad)
        self.slope, self.shift = (float(t[0]) / scale, float(t[1])) if t[0] > 0 else (1.0, 0.0)

    def tables(self) -> list[np.ndarray]:
        """The answer of each filter row to each bucket: a convolution is then a sum of looked-up rows."""
        return [np.hstack([self.embed @ self.filters[w][i * DIM:(i + 1) * DIM] for w in WIDTHS for i in range(w)]).astype(np.float32)]

    def output(self, pairs: np.ndarray, table: np.ndarray) -> float:
        a = table[pairs[:, 0]] + table[pairs[:, 1]]
        tops, at = [], 0
        for w in WIDTHS:
            n = len(a) - w + 1
            if n < 1:
                tops.append(np.zeros(FILTERS))
            else:
                total = a[:n, at:at + FILTERS]
                for i in range(1, w):
                    total = total + a[i:i + n, at + i * FILTERS:at + (i + 1) * FILTERS]
                tops.append(total.max(axis=0))
            at += w * FILTERS
        return float(np.maximum(np.concatenate(tops), 0) @ self.out + self.bias)

    def probability(self, z: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -30, 30))))

    def score(self, pairs: np.ndarray, table: np.ndarray) -> float:
        return self.probability(self.output(pairs, table))


@dataclass
class Fitted:
    network: Network | None
    constant: float
    threshold: float
    by_lang: dict[str, float]


def _best_cut(steps: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> float:
    """The output with the best F1 of label 1 for all rows at it or above, to a step."""
    order = np.argsort(-steps, kind="stable")
    steps, ones, counts = steps[order], (labels * counts)[order], counts[order]
    last = np.append(steps[1:] != steps[:-1], True)  # a step is above the cut as a whole
    f1 = np.where(last, 2 * np.cumsum(ones) / (np.cumsum(counts) + ones.sum()), -1.0)
    return float(steps[int(f1.argmax())]) / STEPS


def encoded(docs: DataFrame, marked: DataFrame, n: int) -> DataFrame:
    """(y, lang, id, ids, unseen, shard): every labelled row with the buckets of its whole text, written once."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder()
        for b in batches:
            ids = pa.array([encode(t.as_py()).astype(np.uint16).tobytes() for t in b.column(3)], pa.binary())
            unseen = pa.array([zlib.crc32(f"{i.as_py()}:{SEED}".encode()) % 5 == 0 for i in b.column(2)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), ids, unseen, b.column(4)],
                                             names=["y", "lang", "id", "ids", "unseen", "shard"])

    labelled = docs.where(~held_out("doc_id", 4, 2)).join(F.broadcast(marked) if n <= BROADCAST_IDS else marked, "doc_id").select(
        "y", F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("string").alias("id"), "text",
        F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(-(-n // SHARD))).cast("int").alias("shard"))
    return materialize(map_arrow(labelled, of, "y int, lang string, id string, ids binary, unseen boolean, shard int"), "toxic-labelled")


def _pairs(ids: pa.Scalar) -> np.ndarray:
    return np.frombuffer(ids.as_py(), dtype=np.uint16).reshape(-1, 2).astype(np.int32)


def trained(rows: DataFrame, share: float) -> Network:
    """The network after all rounds over all ``rows`` (shard, id, y, ids)."""
    vectors = Network.fresh().vectors()
    names = [f"v{k}" for k in range(DIM)]
    for _ in range(ROUNDS):
        start = rows.sparkSession.sparkContext.broadcast(vectors)  # of fixed size

        def of(table: pa.Table) -> pa.Table:
            held = sorted(zip(table["id"].to_pylist(), table["ids"].to_pylist(), table["y"].to_pylist()))
            net = Network.of(start.value)
            net.fit([np.frombuffer(x, dtype=np.uint16).reshape(-1, 2).astype(np.int32) for _, x, _ in held],
                    np.array([y for *_, y in held], dtype=float), share)
            moved = np.rint((net.vectors() - start.value) * FIXED).astype(np.int64)
            at = np.flatnonzero(moved.any(axis=1))
            return pa.table([pa.array(at), *[pa.array(moved[at, k]) for k in range(DIM)]], names=["i", *names])

        moves = rows.groupBy("shard").applyInArrow(of, "i long, " + ", ".join(f"{v} long" for v in names))
        total = moves.groupBy("i").agg(F.count(F.lit(1)).alias("n"), *[F.sum(v).alias(v) for v in names]).toArrow()
        vectors = vectors.copy()
        move = np.stack([total[v].to_numpy() for v in names], axis=1) / FIXED
        vectors[total["i"].to_numpy()] += move / total["n"].to_numpy()[:, None]
    return Network.of(vectors)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Fitted:
    """``docs``: doc_id, text, lang. Trains on all labelled rows that are not held out."""
    marked = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & ~held_out("doc_id", 4, 2)).distinct()
    counts = {r[0]: r[1] for r in marked.groupBy("y").count().collect()}
    n = sum(counts.values())
    share = counts.get(1, 0) / n if n else 0.0
    if not 0 < share < 1:
        return Fitted(None, share, CUT, {})
    rows = encoded(docs, marked, n)
    classes = {(r[0], r[1]) for r in rows.select("unseen", "y").distinct().collect()}  # at most four
    if len({y for unseen, y in classes if not unseen}) < 2:
        return Fitted(None, share, CUT, {})
    net = trained(rows.where("not unseen").select("shard", "id", "y", "ids"), share)
    shared = docs.sparkSession.sparkContext.broadcast((net, net.tables()[0]))  # of fixed size

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, table = shared.value
        for b in batches:
            z = np.array([net.output(_pairs(x), table) for x in b.column(2)], dtype=float)
            steps = np.clip(np.floor(z * STEPS), -REACH, REACH).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(steps)], names=["y", "lang", "step"])

    tests = rows.where(F.col("unseen") == (len({y for unseen, y in classes if unseen}) == 2))
    seen = (map_arrow(tests.select("y", "lang", "ids"), of, "y int, lang string, step long")
            .groupBy("lang", "step", "y").count().orderBy("lang", "step", "y").collect())  # a fixed number for each language
    langs = np.array([r["lang"] or "" for r in seen], dtype=object)
    steps, y, times = (np.array([r[c] for r in seen], dtype=float) for c in ("step", "y", "count"))
    net.calibrate((steps + 0.5) / STEPS, y, times, share)
    cuts = {}
    for name in sorted(set(langs) - {""}):
        own = langs == name
        if len(set(y[own])) == 2:
            cuts[name] = net.probability(_best_cut(steps[own], y[own], times[own]))
    return Fitted(net, share, net.probability(_best_cut(steps, y, times)), cuts)


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, score, predicted (score at 0.3 or more) and flagged (at its language's threshold)."""
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    fitted = fit(given, labels)
    kind = given.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((fitted, fitted.network.tables() if fitted.network else []))  # of fixed size

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tables = shared.value
        encode = Encoder()
        for b in batches:
            s = [model.network.score(encode(t.as_py()), tables[0]) if model.network else model.constant for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(s, pa.float64())], names=["doc_id", "lang", "score"])

    out = map_arrow(given.withColumn("lang", F.col("lang").cast("string")), of, f"doc_id {kind}, lang string, score double")
    cut = F.lit(fitted.threshold)
    if fitted.by_lang:
        by_lang = F.create_map(*[F.lit(x) for k, v in fitted.by_lang.items() for x in (k, v)])
        cut = F.coalesce(F.try_element_at(by_lang, F.col("lang")), cut)
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"),
                      (F.col("score") >= cut).alias("flagged"))
