"""The stages in order, each against brute force or its operator's own decisions."""
from __future__ import annotations

import itertools

import corpus_pipeline as pipeline
from clickgauge.llm import quality
from clickgauge.llm.common import read

from .test_decontam import brute as hits
from .test_jaccard import alike, roots, shingles
from .test_linededup import brute as lines
from .test_simhash import brute_print

SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_each_stage_on_what_the_one_before_kept(spark):
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = read(spark, SF, "documents")
    first, second, third, fourth, last = (f for _, f in pipeline.STAGES)
    a = first(spark, docs, SF)
    good = {r["doc_id"] for r in quality.scored(docs, read(spark, SF, "labels")).where("predicted = 1").collect()}
    assert {r[0] for r in rows(a)} == good and a.columns == docs.columns
    b = second(spark, a, SF)
    assert {(r[0], r[1]) for r in rows(b)} == {(d, t) for d, t, *_ in lines(rows(a), 10)}
    assert all(r[4] == len(r[1]) for r in rows(b))
    c, kept = third(spark, b, SF), sorted(rows(b))
    prints, sets = [brute_print(r[1]) for r in kept], [shingles(r[1]) for r in kept]
    pairs = list(itertools.combinations(range(len(kept)), 2))
    bits = [(i, j) for i, j in pairs if (prints[i] ^ prints[j]).bit_count() <= 2]
    near = [(i, j) for i, j in pairs if alike(sets[i], sets[j])]
    least = {}
    for r, root in zip(kept, roots(len(kept), bits + near)):
        least[root] = min(least.get(root, r[0]), r[0])
    assert {r[0] for r in rows(c)} == set(least.values()) and len(least) < len(set(roots(len(kept), bits)))
    d, items = fourth(spark, c, SF), [tuple(r) for r in read(spark, SF, "benchmark").select("item_id", "text").collect()]
    assert {r[0] for r in rows(d)} == {r[0] for r in rows(c) if not hits(r[1], items)[4]}
    packed = last(spark, d, SF).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r[0] for r in packed} == {r[0] for r in rows(d)} and all(r[1] == r[2] for r in packed)


def test_queries_equal_their_sql(spark):
    import duckdb
    from clickgauge.llm.queries import QUERIES, SQL
    from clickgauge.sources.adapters import TABLES
    from tools.check import compare
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    for name, sql in SQL.items():
        status, _, n, note = compare(spark, con, name, QUERIES[name], sql, SF)
        assert status == "ok" and n, (name, note)
