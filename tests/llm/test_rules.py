from __future__ import annotations

import re
from collections import Counter

from clickgauge.llm import rules


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    hit = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_measures_equal_brute_force(spark, docs, corpus):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = rules.judged(docs).collect()
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(brute(t) for _, t, *_ in corpus)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_order_changes_no_verdict(docs):
    ids = [sorted((r["doc_id"] or -1) for r in rules.cascade(docs, order).select("doc_id").collect())
           for order in (list(rules.RULES), list(reversed(rules.RULES)), None)]
    assert ids[0] == ids[1] == ids[2]
    assert rules.cascade(docs, list(rules.RULES)).columns == docs.columns


def test_order_is_by_rejection_per_cost(docs):
    found = rules.plan_order(docs)
    gains = [share / cost for _, cost, share in found]
    assert {r.name for r, _, _ in found} == {r.name for r in rules.RULES} and gains == sorted(gains, reverse=True)


def test_empty(empty):
    assert rules.judged(empty).count() == 0
