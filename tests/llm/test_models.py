"""The learned operators: held-out accuracy, odd rows, and the parts that have exact answers."""
from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from clickgauge.llm import langid, quality, toxicity

from .conftest import sentence


def labelled(spark, n=900):
    """Ordinary texts, bad ones (repetitive) and toxic ones (two marked words), in two languages of their own letters."""
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        lang = ("en", "de")[i % 2]
        letters = "aeioustrn" if lang == "en" else "aouhkmpzü"
        words = sentence(rng, rng.randint(30, 90), letters)
        bad, toxic = rng.random() < 0.2, rng.random() < 0.2
        if bad:
            words = [w for w in words[:10] for _ in range(8)]
        if toxic:
            for w in ("vilexx", "nastyqq"):
                words.insert(rng.randrange(len(words)), w)
        docs.append((i, " ".join(words), lang, "s", 0))
        labels.append((i, int(not bad), int(toxic)))
    docs += [(n, None, "en", None, None), (n + 1, "", None, None, None), (None, "aa oo", None, None, None), (n + 2, "123 ... 456", "en", None, None), docs[0]]
    labels += [(n + 9, None, None), (None, 1, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs, {x[0]: x for x in labels})


@pytest.fixture(scope="module")
def data(spark):
    return labelled(spark)


def remainder(doc_id, of):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % of


def test_quality(data):
    docs, labels, rows, truth = data
    got = quality.scored(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert all(remainder(r["doc_id"], 5) == 0 for r in held)
    right = [r["predicted"] == truth[r["doc_id"]][1] for r in held if r["doc_id"] in truth]
    assert np.mean(right) > 0.97
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)


def test_quality_without_labels(spark, data, empty):
    docs, labels, rows, _ = data
    assert {r["score"] for r in quality.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.scored(empty, labels).count() == 0


def test_isotonic_is_the_monotone_mean():
    level = quality.isotonic(np.array([2, 0, 2, 2, 4]), np.array([1, 0, 0, 2, 4]))
    assert np.allclose(level, [0.25, 0.25, 0.25, 1, 1])
    assert (np.diff(level) >= 0).all()


def test_normal_equations_do_not_depend_on_partitions(data):
    docs, labels, *_ = data
    a = quality.fit(quality.described(docs.repartition(1)), labels)
    b = quality.fit(quality.described(docs.repartition(7)), labels)
    assert np.allclose(a.weights, b.weights, atol=1e-6)


def test_fit_equals_a_dense_ridge_solution(data):
    """Statistics collected and standardised, features written out, the penalised least squares solved in one piece."""
    docs, labels, *_ = data
    stats = quality.described(docs)
    model = quality.fit(stats, labels)
    marked = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality").distinct()
    rows = stats.join(marked, "doc_id").selectExpr("x", "quality", "pmod(xxhash64(doc_id), 4) = 0 as calibrates").collect()
    x, y, later = np.array([r["x"] for r in rows]), np.array([r["quality"] for r in rows], float), np.array([r["calibrates"] for r in rows])
    sd = x.std(axis=0)
    z = np.clip((x - x.mean(axis=0)) / np.where(sd > 1e-9, sd, 1.0), -8, 8)
    rng = np.random.default_rng(quality.SEED)
    w = rng.standard_normal((x.shape[1], quality.FEATURES)) / np.sqrt(x.shape[1])
    b = rng.uniform(0, 2 * np.pi, quality.FEATURES)
    f = np.array([[np.sqrt(2 / quality.FEATURES) * math.cos(sum(zi * wi for zi, wi in zip(row, w[:, k])) + b[k]) for k in range(quality.FEATURES)] + [1.0] for row in z])
    f, y, scored = f[~later], y[~later], f[later]
    penalty = math.sqrt(quality.RIDGE * len(rows) / f.shape[1])
    dense = np.linalg.lstsq(np.vstack([f, penalty * np.eye(f.shape[1])]), np.concatenate([y, np.zeros(f.shape[1])]), rcond=None)[0]
    assert np.abs(f @ dense - f @ model.weights).max() < 1e-6 and np.abs(scored @ dense - scored @ model.weights).max() < 1e-6
    assert (np.diff(model.knots) >= -1e-12).all()


def test_logit_equals_a_naive_convolution():
    """Loops over positions, filters and dimensions, largest answer first, then the rectifier and the output row."""
    rng = np.random.default_rng(4)
    net = toxicity.Network.fresh()
    for n in (1, 2, 5):
        pairs = rng.integers(0, toxicity.BUCKETS, (n, 2)).astype(np.int32)
        words = [[float(net.embed[a][d] + net.embed[b][d]) for d in range(toxicity.DIM)] for a, b in pairs]
        pooled = []
        for width in toxicity.WIDTHS:
            for k in range(toxicity.FILTERS):
                answers = [sum(words[at + i][d] * net.filters[width][i * toxicity.DIM + d][k] for i in range(width) for d in range(toxicity.DIM))
                           for at in range(n - width + 1)]
                pooled.append(max(0.0, *answers, 0.0) if answers else 0.0)
        assert abs(sum(h * o for h, o in zip(pooled, net.out)) + net.bias - net.logit(pairs)) < 1e-9


def test_toxicity(data, empty):
    docs, labels, rows, truth = data
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert all(remainder(r["doc_id"], 4) == 2 for r in held)
    assert np.mean([r["predicted"] == truth[r["doc_id"]][2] for r in held if r["doc_id"] in truth]) > 0.95
    assert {r["score"] for r in toxicity.scored(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.scored(empty, labels).count() == 0


def test_looked_up_convolution_equals_the_network():
    rng = np.random.default_rng(1)
    net = toxicity.Network.fresh()
    for n in (0, 1, 2, 3, 50):
        pairs = rng.integers(0, toxicity.BUCKETS, (n, 2)).astype(np.int32)
        z = net.logit(pairs)
        assert abs(net.score(pairs, net.tables()[0]) - 1 / (1 + np.exp(-z))) < 1e-5


def test_language(data, empty):
    docs, _, rows, _ = data
    got = langid.predicted(docs).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    truth = {d: (t, lang) for d, t, lang, *_ in rows}
    for r in got:
        if r["doc_id"] is None:
            continue
        text, lang = truth[r["doc_id"]]
        if not any(c.isalpha() for c in text or ""):
            assert r["lang_pred"] == "und" and r["score"] == 0
        elif r["held_out"]:
            assert r["lang_pred"] == lang
    assert langid.predicted(empty).count() == 0


def naive(rows):
    """Dictionaries of the interpolated model: rows (text, lang); gives the log probability of a four-gram in a language."""
    tables = {}
    for text, lang in rows:
        grams = tables.setdefault(lang, Counter())
        for w in langid.words_of(text):
            padded = "\x01" * 3 + w + "\x02"
            grams.update(padded[i:i + 4] for i in range(len(w) + 1))
    orders = {}
    for lang, grams in tables.items():
        now = dict(grams)
        for k in range(4, 0, -1):
            ones, twos = (sum(n == c for n in now.values()) for c in (1, 2))
            d = max(ones / (ones + 2 * twos), 0.1) if ones + twos else 0.5
            total, kinds = Counter(), Counter()
            for g, n in now.items():
                total[g[:-1]] += n
                kinds[g[:-1]] += 1
            orders[lang, k] = (now, d, total, kinds)
            now = dict(Counter(g[1:] for g in now))
    floor = 1 / max(64, 2 * sum(len(orders[x, 1][0]) for x in tables))

    def p(lang, g):
        if not g:
            return floor
        n, d, total, kinds = orders[lang, len(g)]
        c = g[:-1]
        if c not in total:
            return p(lang, g[1:])
        return max((n.get(g, 0) - d) / total[c], 0.0) * (g in n) + d * kinds[c] / total[c] * p(lang, g[1:])

    return sorted(tables), lambda lang, g: math.log(p(lang, g))


def entropy(logp, lang, text):
    words = langid.words_of(text)
    padded = ["\x01" * 3 + w + "\x02" for w in words]
    return -sum(logp(lang, w[i:i + 4]) for w in padded for i in range(len(w) - 3)) / sum(len(w) - 3 for w in padded)


@pytest.mark.parametrize("cells", [langid.CELLS, 300, 0])
def test_entropies_equal_dictionaries(data, cells):
    """However few grams a task holds, the sums are those of the whole model, for seen and unseen grams."""
    docs, _, rows, _ = data
    asked = [(1, rows[0][1]), (2, rows[1][1]), (3, "zzz qqq Ünknown"), (4, rows[3][1] + " 漢字 " + rows[2][1])]
    trained = langid.train(docs.where("doc_id < 300"))
    langs, logp = naive([(t, lang) for d, t, lang, *_ in rows if d is not None and d < 300 and lang])
    got = {r["doc_id"]: r for r in langid.identified(docs.sparkSession.createDataFrame(asked, "doc_id long, text string"), trained, cells=cells).collect()}
    assert trained.langs == langs == ["de", "en"]
    for i, text in asked:
        h = {x: entropy(logp, x, text) for x in langs}
        best = min(langs, key=lambda x: h[x])
        assert got[i]["lang_pred"] == best and abs(got[i]["entropy"] - h[best]) < 1e-5
        assert abs(got[i]["score"] - 1 / sum(math.exp(-langid.SHARPNESS * (h[x] - h[best])) for x in langs)) < 1e-4


def test_many_languages_told_apart_by_rare_grams(spark):
    """Sixty languages of the same letters, each with a few words of its own, one in a script above U+FFFF."""
    rng = random.Random(5)
    common, rows, asked = sentence(rng, 200), [], []
    scripts = ["aeioustrn"] * 58 + ["".join(map(chr, range(0x1E900, 0x1E920))), "".join(map(chr, range(0x104B0, 0x104D0)))]
    own = [["".join(rng.choice(letters) for _ in range(9)) for _ in range(12)] for letters in scripts]
    for i, words in enumerate(own):
        name = f"l{i:02d}"
        for _ in range(6):
            text = words + (rng.sample(common, 60) if i < 58 else [])
            rng.shuffle(text)
            rows.append((len(rows), " ".join(text), name))
        asked.append((i, " ".join(rng.sample(words, 6) + (rng.sample(common, 30) if i < 58 else [])), name))
    trained = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for cells in (langid.CELLS, 60_000):
        got = langid.identified(spark.createDataFrame(asked, "doc_id long, text string, lang string"), trained, keep=("lang",), cells=cells).collect()
        assert len(got) == 60 and all(r["lang"] == r["lang_pred"] for r in got)


def test_kneser_ney_sums_to_one(data):
    """Over all characters that may follow a context, in either language."""
    docs, *_ = data
    trained = langid.train(docs)
    last = {r["gram"] for r in trained.shares[1].where("lang = 'en'").collect()}
    for context in ("\x01\x01\x01", "aei", "zzz"):
        head = sum(ord(c) << 16 * (3 - i) for i, c in enumerate(context))
        grams = docs.sparkSession.createDataFrame([(head | g,) for g in last], "gram long")
        total = sum(np.exp(r["logp"][1]) for r in trained.probabilities(grams).collect())
        assert 0.9 < total <= 1.0 + 1e-9


def test_gram_counts_cover_all_rows(data):
    docs, _, rows, _ = data
    n = sum(len(w) + 1 for _, t, lang, *_ in rows if lang for w in langid.words_of(t))
    assert langid.gram_counts(docs.repartition(5), "text", "lang").selectExpr("sum(n)").first()[0] == n


def test_toxicity_learns_from_every_labelled_row(spark):
    """A mark that only one row in thousands has, in a text of over 20,000 words, moves its own embedding; cuts come from all unseen rows."""
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(4000):
        docs.append((i, " ".join(sentence(rng, 6)) + (" vilexx" if i % 3 == 0 else ""), "en"))
        labels.append((i, int(i % 3 == 0)))
    alone = next(i for i in range(4000, 5000) if remainder(i, 4) != 2 and zlib.crc32(f"{i}:{toxicity.SEED}".encode()) % 5)
    docs.append((alone, "solitaryzz " * 25_000, "en"))
    labels.append((alone, 1))
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    fitted = toxicity.fit(docs.repartition(3), labels)
    at = zlib.crc32(b"solitaryzz") % toxicity.BUCKETS
    assert not np.array_equal(fitted.network.embed[at], toxicity.Network.fresh().embed[at])
    again = toxicity.fit(docs.repartition(7), labels.repartition(2))
    assert np.array_equal(fitted.network.vectors(), again.network.vectors()) and fitted.by_lang == again.by_lang


def test_merged_shards_tell_classes_apart(data, monkeypatch):
    docs, labels, rows, truth = data
    monkeypatch.setattr(toxicity, "SHARD", 200)
    monkeypatch.setattr(toxicity, "BROADCAST_IDS", 0)
    got = [r for r in toxicity.scored(docs, labels).collect() if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]][2] for r in got]) > 0.95


def test_best_cut_equals_trying_every_step():
    rng = np.random.default_rng(2)
    steps, y, n = rng.integers(-9, 9, 40).astype(float), rng.integers(0, 2, 40).astype(float), rng.integers(1, 9, 40).astype(float)
    f1 = {c: 2 * (y * n)[steps >= c].sum() / (n[steps >= c].sum() + (y * n).sum()) for c in set(steps)}
    assert f1[toxicity._best_cut(steps, y, n) * toxicity.STEPS] == max(f1.values())
