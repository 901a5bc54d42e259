from __future__ import annotations

import itertools
import random

from clickgauge.llm import jaccard, simhash

from .conftest import sentence
from .test_simhash import brute_print


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    return bool(a and b) and 5 * len(a & b) >= 4 * len(a | b)


def roots(n, pairs):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in pairs:
        parent[root(j)] = root(i)
    return [root(i) for i in range(n)]


def texts():
    """Edited copies at every distance, a family too wide to be one star, and a passage that many texts share."""
    rng = random.Random(3)
    out = []
    for n in (6, 30, 90, 400):
        base = sentence(rng, n)
        for k in (0, 1, 2, 3, 5, 8):
            edited = list(base)
            for at in rng.sample(range(n), min(k, n)):
                edited[at] = "".join(sentence(rng, 1))
            out.append(" ".join(edited))
    base = sentence(rng, 120)
    for k in range(40):  # each step drops words in front and adds others behind
        out.append(" ".join(base[3 * k:] + sentence(rng, 3 * k)) if k < 30 else " ".join(base[:90] + sentence(rng, 30)))
    passage = sentence(rng, 60)
    out += [" ".join(sentence(rng, 20) + passage + sentence(rng, 20)) for _ in range(30)]
    return out + ["", None, "one two", "ONE  two", "one two three"]


def test_classes_equal_all_pairs(spark):
    given = texts()
    docs = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(4)
    sets = [shingles(t) for t in given]
    want = roots(len(given), [(i, j) for i, j in itertools.combinations(range(len(given)), 2) if alike(sets[i], sets[j])])
    named = {r["th"]: r["doc_id"] for r in docs.selectExpr("xxhash64(text) th", "doc_id").collect()}
    got = roots(len(given), [(named[r["a"]], named[r["b"]]) for r in jaccard.links(docs).collect()])
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_prefixes_of_similar_sets_meet_in_any_order():
    rng = random.Random(5)
    heavy = jaccard.np.sort(jaccard.np.array([rng.getrandbits(62) for _ in range(50)], dtype="int64"))
    for _ in range(500):
        n = rng.randint(1, 60)
        a = {int(h) for h in rng.sample(list(heavy), rng.randint(0, 40))} | {rng.getrandbits(62) for _ in range(n)}
        b = {x for x in a if rng.random() > 0.1} | {rng.getrandbits(62) for _ in range(rng.randint(0, 5))}
        if alike(a, b):
            p, q = (set(jaccard.prefix(jaccard.np.sort(jaccard.np.array(list(x), dtype="int64")), heavy).tolist()) for x in (a, b))
            assert p & q


def test_keep_one_drops_edited_copies_that_two_bits_miss(spark):
    rng = random.Random(11)
    base = sentence(rng, 100)
    a, b = " ".join(base), " ".join(base[:30] + ["edit"] + base[31:70] + ["edit"] + base[71:])
    assert (brute_print(a) ^ brute_print(b)).bit_count() > simhash.RADIUS and alike(shingles(a), shingles(b))
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert [r["doc_id"] for r in simhash.keep_one(docs).collect()] == [1]


def test_a_template_gives_no_square_of_candidates(spark, monkeypatch):
    """Texts of one form, similar at 0.73, have no links: candidates stay in proportion to the texts."""
    made = {}
    real = jaccard.materialize

    def counting(df, label):
        out = real(df, label)
        made[label] = made.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "materialize", counting)
    rng = random.Random(9)
    form = sentence(rng, 20)
    for n in (200, 400):
        made.clear()
        docs = spark.createDataFrame([(i, " ".join(form[:9] + [f"w{i}a", f"w{i}b", f"w{i}c"] + form[9:])) for i in range(n)], "doc_id long, text string")
        assert jaccard.links(docs).count() == 0
        assert made["star-pairs"] + made.get("more-pairs", 0) <= n


def test_parity_maps_lose_no_similar_pair(spark):
    """Neither the short map nor the wide one, equal in width or folded."""
    from pyspark.sql import functions as F
    rng, rows, kinds = random.Random(6), [], set()
    for i in range(400):
        a = {rng.getrandbits(62) for _ in range(rng.choice([1, 40, 250, 270, 500, 1000, 1100]) + rng.randint(0, 30))}
        b = {x for x in a if rng.random() > 0.1} | {rng.getrandbits(62) for _ in range(rng.randint(0, 60))}
        p, q = (jaccard.np.array(sorted(x), dtype="int64") for x in (a, b))
        if len(b) and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
            kinds.add(len(jaccard.wide(p)) == len(jaccard.wide(q)))
            rows.append((alike(a, b), len(a), len(b), *[f(x).tolist() for f in (jaccard.parity, jaccard.wide) for x in (p, q)]))
    df = spark.createDataFrame(rows, "alike boolean, n int, k int, ma array<long>, mb array<long>, wa array<long>, wb array<long>")
    short = jaccard._agree(F.col("n"), F.col("k"), F.col("ma"), F.col("mb"))
    wide = jaccard._agree_wide(F.col("n"), F.col("k"), F.col("wa"), F.col("wb"))
    got = df.select("alike", short.alias("short"), wide.alias("wide")).collect()
    assert kinds == {True, False} and all(r["short"] and r["wide"] for r in got if r["alike"]) and sum(r["alike"] for r in got) > 100
    assert sum(not r["wide"] for r in got) > 0
