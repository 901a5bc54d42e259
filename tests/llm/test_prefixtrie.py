"""The trie against a dictionary of prefixes."""
from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from clickgauge.llm import prefixtrie as P

SCHEMA = "conv_id long, turn long, role string, text string, k1 string, size string, shard string"


def brute(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    members = {}
    for c, t in made.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    children, leaves, saved = ({p: 0 for p in members} for _ in range(3))
    for p in sorted(members, key=len, reverse=True):
        if not children[p]:
            leaves[p] = 1
        if p:
            saved[p] += (len(members[p]) - 1) * len(p[-1][1].encode())
            children[p[:-1]] += 1
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    out = []
    for p, m in members.items():
        ids = ",".join(map(str, sorted(c for c in m if len(made[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows():
    rng = random.Random(2)
    said = ["", "a", "bö", "hello there", None]
    out = []
    for c in range(150):
        for turn in range(rng.choice([1, 2, 3, 6, 9])):
            out.append((c, turn, rng.choice(["user", "assistant"]) if turn > 1 else "user", said[0] if c % 3 else rng.choice(said)))
    for c in range(1000, 1200):  # a group of copies
        out += [(c, t, "user", f"same {t}") for t in range(3)]
    for c in range(2000, 2012):  # long ones that part late
        out += [(c, t, "user", f"long {t}" if t < 50 + c % 5 * 9 else f"{c} {t}") for t in range(120)]
    out += [(3001, None, "user", "x"), (3001, None, "assistant", "y"), (3001, 1, None, None), (3001, 1, None, None), (3001, 1, "user", "tie")]
    out += [(None, 0, "user", "no conversation"), (9_007_199_254_740_993, 0, "user", "big id"), (4, 2, "user", "more")]
    return [(*r, "x", "y", "z") for r in out]


@pytest.fixture(scope="module")
def given(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.mark.parametrize(("limit", "queue", "chunk"), [(None, 500_000, 1 << 16), (40, 3, 20), (0, 1, 1), (10**9, 1, 7)])
def test_equals_a_dictionary_of_prefixes(given, limit, queue, chunk):
    """Whatever the size of a shard, with all nodes in the top tree or none, and with a queue that spills."""
    got = sorted((tuple(r) for r in P.trie(given, limit, queue, chunk).collect()), key=repr)
    assert got == brute(rows())


def test_shards_hold_whole_subtrees_and_the_top_tree_is_small(given):
    placed, trie_rows = P.nodes(P.rebuilt(P.turns_in_order(given))[1], 40)
    placed = placed.collect()
    by_key = {(r["k1"], r["k2"]): r for r in placed}
    assert any(r["shard"] is None for r in placed) and len({r["shard"] for r in placed}) > 20
    for r in placed:
        up = by_key.get((r["p1"], r["p2"]))
        assert up is None or up["shard"] is None or up["shard"] == r["shard"]
        assert r["shard_root"] == (r["shard"] is not None and (up is None or up["shard"] is None))


def test_queue_gives_back_all_in_order_and_spills():
    rng, queue = random.Random(3), P.SpillingQueue(5)
    sent = [(-rng.randint(0, 9), rng.randint(0, 3), 0, 1, i, 0) for i in range(300)]
    for m in sent:
        queue.push(m)
    got = [m for place in sorted({m[:3] for m in sent}) for m in queue.take(place)]
    assert sorted(got) == sorted(sent) and [m[:3] for m in got] == sorted(m[:3] for m in sent) and queue.spilled > 10
    assert not queue.heap and not queue.runs


def test_no_conversations(spark):
    assert P.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert P.trie(spark.createDataFrame([(None, 1, "user", "x", "", "", "")], SCHEMA)).count() == 0
