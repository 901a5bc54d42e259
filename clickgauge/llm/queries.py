"""The registered queries of this folder and the SQL each must equal, where SQL can say it."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, importance, langid, licences, linededup, packing, pagetext, prefixtrie, quality, rules, secrets, simhash, toxicity
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return wrap


@register("op3_licences", licences.sql())
def op3_licences(spark, sf_dir):
    return licences.report(licences.scan(read(spark, sf_dir, "documents")))


@register("op4_secrets", secrets.sql())
def op4_secrets(spark, sf_dir):
    return secrets.report(secrets.scan(read(spark, sf_dir, "documents")))


@register("op10_quality_rules", rules.SQL)
def op10_quality_rules(spark, sf_dir):
    return rules.judged(read(spark, sf_dir, "documents"))


@register("op2_simhash")
def op2_simhash(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@register("op7_packing")
def op7_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), packing.tokenizer_path())


@register("op1_line_dedup", linededup.SQL)
def op1_line_dedup(spark, sf_dir):
    return linededup.dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_boilerplate", "n_removed", "text")


@register("op5_decontamination", decontam.SQL)
def op5_decontamination(spark, sf_dir):
    return decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    return toxicity.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register("op8_quality")
def op8_quality(spark, sf_dir):
    return quality.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register("op9_language")
def op9_language(spark, sf_dir):
    return langid.predicted(read(spark, sf_dir, "documents"))


@register("op12_importance", importance.SQL)
def op12_importance(spark, sf_dir):
    return importance.resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("n_words")


@register("op11_prefix_trie", prefixtrie.SQL)
def op11_prefix_trie(spark, sf_dir):
    return prefixtrie.trie(read(spark, sf_dir, "conversations"))


@register("op13_page_text")
def op13_page_text(spark, sf_dir):
    return pagetext.extracted(read(spark, sf_dir, "pages"))
