from __future__ import annotations

import re
from collections import Counter, defaultdict

from clickgauge.llm import linededup

BLANKS = " \t\n\x0b\f\r"


def brute(rows, min_sites, long_sites=4):
    sites = defaultdict(set)
    for _, t, _, s, _ in rows:
        for line in (t or "").split("\n"):
            if line.strip(BLANKS) and s is not None:
                sites[line.strip(BLANKS)].add(s)
    out = Counter()
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        need = lambda x: long_sites if len(re.split("[ \t-\r]+", x)) >= 50 else min_sites
        kept = [x for x in lines if len(sites[x.strip(BLANKS)]) < need(x.strip(BLANKS))]
        cut = len(kept) < len(lines) and any(x.strip(BLANKS) for x in kept)
        out[(d, "\n".join(kept) if cut else t, sum(bool(x.strip(BLANKS)) for x in lines), len(lines) - len(kept))] += 1
    return out


def test_equals_exact_counts(docs, corpus):
    for sites in (10, 12, 2):
        got = linededup.dedup(docs, min_sites=sites).select("doc_id", "text", "n_lines", "n_boilerplate").collect()
        assert Counter(map(tuple, got)) == brute(corpus, sites)


def test_columns_stay(docs, empty):
    assert linededup.dedup(docs, report=False).columns == docs.columns
    assert linededup.dedup(empty).count() == 0


def test_mostly_boilerplate_loses_it_and_only_boilerplate_stays(spark):
    from .conftest import DOCS
    shared = "a notice on every page that is much longer than the rest"
    texts = [f"own {i}\n{shared}" for i in range(10)] + [shared, f"\n{shared}\n", "own"]
    docs = spark.createDataFrame([(i, t, None, f"site{i}", len(t)) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in linededup.dedup(docs).collect()}
    assert got == {**{i: (f"own {i}", 1) for i in range(10)}, 10: (shared, 0), 11: (f"\n{shared}\n", 0), 12: ("own", 0)}
    import corpus_pipeline
    stage = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert stage == {i: t for i, (t, _) in got.items()}


def test_long_lines_need_fewer_sites_and_clashing_columns_are_replaced(spark):
    from pyspark.sql import functions as F
    from .conftest import DOCS
    passage, label = " ".join(f"word{i}" for i in range(50)), " ".join(f"word{i}" for i in range(49))
    rows = [(i, f"own {i}\n{passage}\n{label}", None, f"site{i % 4}", 0) for i in range(8)]
    docs = spark.createDataFrame(rows, DOCS)
    assert Counter(map(tuple, linededup.dedup(docs).select("doc_id", "text", "n_lines", "n_boilerplate").collect())) == brute(rows, 10)
    got = linededup.dedup(docs.withColumn("n_lines", F.lit("caller's")).withColumn("n_removed", F.lit(None))).collect()
    assert {(r["doc_id"], r["text"], r["n_lines"], r["n_boilerplate"], r["n_removed"]) for r in got} == {(i, f"own {i}\n{label}", 3, 1, 1) for i in range(8)}
    fewer = linededup.dedup(docs.where("source <> 'site3'")).collect()
    assert all(r["n_removed"] == 0 for r in fewer), "three sites are one too few"
