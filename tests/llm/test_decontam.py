from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest

from clickgauge.llm import decontam


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    w, hit, found = words(text), set(), []
    for item, t in items:
        v = words(t)
        n = min(10, len(v))
        wins = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
        at = [i for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in wins] if wins else []
        hit |= {j for i in at for j in range(i, i + n)}
        if at and item is not None:
            found.append(str(item))
    return len(w), len(hit), len(set(found)), hashlib.sha256(",".join(sorted(set(found))).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("rows", [None, 0])
def test_equals_brute_force(spark, docs, corpus, passage, rows, monkeypatch):
    if rows is not None:
        monkeypatch.setattr(decontam, "BROADCAST_ROWS", rows)  # the way without a broadcast
    items = [(0, passage), (1, passage), (2, "one TWO"), (3, None), (4, ""), (10, " ".join(["same"] * 12)), (11, "a"), (12, "zz yy xx ww vv uu tt ss rr qq pp"),
             (13, (corpus[20][1] or "")[:90]), (None, "one two")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(docs, bench).collect()
    assert Counter(tuple(r)[1:] for r in got) == Counter(brute(t, items) for _, t, *_ in corpus)


def test_clean_keeps_the_rest(spark, docs, corpus, passage):
    bench = spark.createDataFrame([(0, passage)], "item_id long, text string")
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not brute(t, [(0, passage)])[4] for _, t, *_ in corpus) < len(corpus)


def test_every_shared_span_has_a_common_fingerprint(spark):
    import random
    rng = random.Random(5)
    span = [str(rng.randint(0, 9)) for _ in range(10)]
    pairs = [([str(rng.randint(0, 9)) for _ in range(rng.randint(0, 15))] + span + [str(rng.randint(0, 9)) for _ in range(rng.randint(0, 15))])
             for _ in range(30)]
    df = spark.createDataFrame([(" ".join(p),) for p in pairs], "text string")
    prints = [{x["h"] for x in r[0]} for r in df.select(decontam.winnowed(decontam.words(df.text))).collect()]
    assert set.intersection(*prints)


def test_empty_tables(spark, docs, empty, corpus):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(empty, none).count() == 0
    out = decontam.contamination(docs, none).collect()
    assert len(out) == len(corpus) and not any(r["contaminated"] for r in out)
