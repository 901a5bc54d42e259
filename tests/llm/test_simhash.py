from __future__ import annotations

import itertools
import random

import numpy as np
import xxhash

from clickgauge.llm import simhash
from clickgauge.llm.components import components

from .conftest import CLASHING


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            parent[root(j)] = root(i)
    return [root(i) for i in range(len(prints))]


def test_masks_cover_every_pair_within_the_radius():
    masks = [m & (2 ** 64 - 1) for m in simhash.masks()]
    assert len(masks) == 7
    for i, j in itertools.product(range(64), repeat=2):
        assert any(not m & ((1 << i) | (1 << j)) for m in masks)


def test_classes_equal_brute_force(docs, corpus):
    got = simhash.near_duplicates(docs).collect()
    rows = [(d, brute_print(t)) for d, t, *_ in corpus]
    roots = classes([p for _, p in rows])
    least = {}
    for (d, _), r in zip(rows, roots):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    want = [(d if d is not None else -1, f"{p:016x}", least.get(r, -1)) for (d, p), r in zip(rows, roots)]
    assert sorted((-1 if r[0] is None else r[0], r[1], -1 if r[2] is None else r[2]) for r in got) == sorted(want)


def test_crowded_buckets_lose_no_link(spark):
    rng = random.Random(1)
    center = rng.getrandbits(64)
    prints = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(300)} | {rng.getrandbits(64) for _ in range(50)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {r["fp"]: r["root"] for r in simhash.classes(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    want = classes([p & (2 ** 64 - 1) for p in signed])
    assert len({(a, b) for a, b in zip([got[p] for p in signed], want)}) == len(set(want)) == len(set(got.values()))


def test_keep_one(docs, corpus):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and set(CLASHING) <= set(kept.columns)
    roots = classes([brute_print(t) for _, t, *_ in corpus])
    assert kept.count() == len(set(roots))


def test_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 300)] + [(7, 7), (None, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 300)}}


def test_long_text_in_chunks():
    words = np.random.default_rng(0).integers(0, 50, simhash.CHUNK + 500).astype(str)
    text = " ".join(words)
    fp = simhash.fingerprint(text.encode()) & (2 ** 64 - 1)
    hashes = np.array([xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(len(words) - 2)], dtype=np.uint64)
    assert all((fp >> b & 1) == (2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(hashes)) for b in range(64))
