"""Importance resampling against a plain loop."""
from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from clickgauge.llm import importance as I

from .conftest import DOCS, sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute(rows, items, percent=25):
    rows = [(i, *features(t)) for i, t in rows]
    corpus, target = Counter(b for r in rows for b in r[2]), Counter(b for t in items for b in features(t)[1])
    s_all, t_all = sum(corpus.values()) + 10000, sum(target.values()) + 10000
    gain = [math.floor(1000 * math.log((target[b] + 1) * s_all / ((corpus[b] + 1) * t_all))) for b in range(10000)]
    out = []
    for i, words, buckets in rows:
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= 20])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_equals_a_plain_loop(spark, docs, corpus):
    rng = random.Random(4)
    items = [" ".join(sentence(rng, 30)), "Ünï cödé", None, "", corpus[12][1]]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    for percent in (25, 0, 100):
        assert got(I.resampled(docs, target, percent=percent)) == brute([(r[0], r[1]) for r in corpus], items, percent)


def test_copies_tie_by_score_and_ids_decide(spark):
    """A group of copies shares its weight; equal scores are ordered by id."""
    scored = spark.createDataFrame([(i, 5 - i % 2, i != 3) for i in range(40)], "doc_id long, score long, eligible boolean").repartition(5)
    rank = {r["doc_id"]: r["rank"] for r in I.draw(scored, 50).collect()}
    assert [i for i in sorted(rank, key=lambda i: (rank[i] is None, rank[i])) if rank[i]] == list(range(0, 38, 2))


def test_empty_tables(spark, empty, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert I.resampled(empty, none).count() == 0
    assert I.resampled(docs, none).where("rank is not null").count() > 0
    assert I.resampled(spark.createDataFrame([(1, None, None, None, None)], DOCS), none).first()["weight"] == 0


@pytest.mark.parametrize("size", [1, 7, 10**9])
def test_slices_cover_every_row_once(size):
    texts = pa.array(["a" * n for n in (0, 5, 100, 0, 3, 3)] + [None])
    cut = list(I.slices(texts, size))
    assert [i for at, n in cut for i in range(at, at + n)] == list(range(7))


def test_crc_of_joined_bytes():
    rng, shift = random.Random(1), I.Shift()
    for _ in range(50):
        a, b = rng.randbytes(rng.randint(0, 9)), rng.randbytes(rng.choice([0, 1, 2, 3, 200, 70_000]))
        joined = shift(np.array([zlib.crc32(a)], dtype=np.uint32), np.array([len(b)]))[0] ^ zlib.crc32(b)
        assert joined == zlib.crc32(a + b)
