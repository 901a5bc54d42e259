"""Quality rules as a short-circuit cascade.

Each rule is a predicate over one measure of the text. ``plan_order`` runs every rule on a bounded
sample, takes the seconds it costs and the share it rejects, and orders the rules by rejection per
cost. The cascade is one CASE expression in that order, so a text stops at the first rule that
rejects it and dearer measures are never computed for it. The order changes the work, never the
verdict: a document is kept exactly if no rule rejects it.

Null texts count as empty: no words, rejected as too short. Repeated rows are judged alike, one row
out for each row in. An empty table gives an empty result. Columns besides ``id`` and ``text`` are ignored.
"""
from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bind
from .common import blank_separated, positions, whole

SPAN = 8
SAMPLE_ROWS = 500
SAMPLE_CHARS = 20_000


def repeated_words(words: Column, span: int = SPAN) -> Column:
    """Words that lie in a window of ``span`` words found twice or more; every such window counts."""
    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(positions(F.size(h)), lambda i: F.struct(h[i].alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            last = F.size(p) - 1
            twice = F.filter(positions(F.size(p)), lambda j: (
                ((j > 0) & (F.get(p, j - 1)["h"] == F.get(p, j)["h"]))
                | ((j < last) & (F.get(p, j + 1)["h"] == F.get(p, j)["h"]))))
            return F.array_sort(F.transform(twice, lambda j: F.get(p, j)["i"]))

        def union_length(s: Column) -> Column:
            steps = F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), lambda a, b: F.coalesce(F.least(F.lit(span), b - a), F.lit(span)))
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda t, x: t + x)

        return bind(bind(ordered, starts), union_length)

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (span - 1)), lambda i: F.xxhash64(F.slice(w, i, F.lit(span))))
        several = bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("bigint")))
        return F.when(F.size(w) > span, several).otherwise(F.lit(0).cast("bigint"))

    return of(words)


def _count(c: Column) -> Column:
    return c.cast("bigint")


def _class_count(t: Column, chars: str) -> Column:
    return _count(F.length(t) - F.length(F.regexp_replace(t, chars, "")))


def _dup_lines(t: Column) -> Column:
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "")
    return bind(lines, lambda x: _count(F.size(x) - F.size(F.array_distinct(x))))


MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    # name -> f(text, words)
    "n_words": lambda t, w: _count(F.size(w)),
    "word_chars": lambda t, w: _count(F.length(F.array_join(w, ""))),
    "n_symbols": lambda t, w: _class_count(t, "[#*$%&|<>]"),
    "n_dup_lines": lambda t, w: _dup_lines(t),
    "n_repeat_words": lambda t, w: repeated_words(w),
    "n_capitals": lambda t, w: _class_count(t, "[A-Z]"),
    "n_alone": lambda t, w: _count(F.size(F.filter(w, lambda x: F.length(x) == 1))),
}


@dataclass(frozen=True)
class Rule:
    """Rejects a text if ``rejects`` holds; ``needs`` names the measures it reads."""
    name: str
    needs: tuple[str, ...]
    rejects: Callable[[dict[str, Column]], Column]


RULES = (
    Rule("too_short", ("n_words",), lambda m: m["n_words"] < 20),
    Rule("repetition", ("n_words", "n_repeat_words"), lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    Rule("symbols", ("word_chars", "n_symbols"), lambda m: 100 * m["n_symbols"] > 5 * m["word_chars"]),
    Rule("shouting", ("word_chars", "n_capitals"), lambda m: 100 * m["n_capitals"] > 50 * m["word_chars"]),
    Rule("word_length", ("n_words", "word_chars"),
         lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 20 * m["n_words"])),
    Rule("single_characters", ("n_words", "n_alone"), lambda m: 100 * m["n_alone"] > 50 * m["n_words"]),
    Rule("duplicate_lines", ("n_words", "n_dup_lines"), lambda m: 5 * m["n_dup_lines"] > m["n_words"]),
)
BASE = ("too_short", "repetition")


def measures(docs: DataFrame, names, text: str = "text", keep=()) -> DataFrame:
    """``keep`` columns and one column for each named measure of the whole text."""
    worded = docs.select(*keep, whole(text).alias("_t"))
    made = bind(F.col("_t"), lambda t: bind(blank_separated(t), lambda w: F.struct(
        *[MEASURES[n](t, w).alias(n) for n in names])))
    return worded.select(*keep, made.alias("_m")).select(*keep, "_m.*")


def plan_order(docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) on at most ``sample_rows`` rows, best rejection per cost first.

    Only the order comes from the sample, which reads no more of the table than it needs and leaves out
    texts beyond ``SAMPLE_CHARS``. With no rows to sample, the rules keep their given order."""
    few = docs.select(F.col(text).cast("string").alias("_s")).where(F.length("_s") <= SAMPLE_CHARS).take(sample_rows)
    sample = docs.sparkSession.createDataFrame(few, "_s string")
    found = []
    for rule in rules:
        began = time.perf_counter()
        row = (measures(sample, rule.needs, "_s").select(rule.rejects({n: F.col(n) for n in rule.needs}).alias("x"))
               .agg(F.avg(F.col("x").cast("double"))).first())
        found.append((rule, time.perf_counter() - began, row[0] or 0.0))
    return sorted(found, key=lambda x: -x[2] / x[1])


def _measured_rule(rule: Rule, missing: list[str], given: dict[str, Column], text: Column) -> Column:
    def of(words):
        return bind(F.struct(*[MEASURES[n](text, words).alias(n) for n in missing]),
                    lambda s: rule.rejects({n: s[n] if n in missing else given[n] for n in rule.needs}))
    return bind(blank_separated(text), of)


def verdict(rules, given: dict[str, Column] | None = None, text: Column | None = None) -> Column:
    """Name of the first rule that rejects, in the order given; null if none does.

    Measures in ``given`` are read from there; others are computed from ``text`` when their rule is reached."""
    given = given or {}
    case = None
    for rule in rules:
        missing = [n for n in rule.needs if n not in given]
        if missing:
            if text is None:
                raise ValueError(f"{rule.name} needs {missing}")
            lazily = _measured_rule(rule, missing, given, text)
        else:
            lazily = rule.rejects(given)
        case = F.when(lazily, rule.name) if case is None else case.when(lazily, rule.name)
    return case if case is not None else F.lit(None).cast("string")


def cascade(docs: DataFrame, rules=None, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, all columns as they came."""
    rules = rules or [r for r, _, _ in plan_order(docs, text=text)]
    return docs.where(verdict(rules, text=whole(text)).isNull())


def judged(docs: DataFrame, rules=RULES, base=BASE, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the base measures, ``base_failed`` and the cascade's ``kept``."""
    order = [r for r, _, _ in plan_order(docs, rules, text)]
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    row = docs.select(F.col(id_col).alias("doc_id"), whole(text).alias("_t"))
    out = row.select("doc_id", "_t", bind(F.col("_t"), lambda t: bind(blank_separated(t), lambda w: F.struct(
        *[MEASURES[n](t, w).alias(n) for n in shown]))).alias("_m")).select("doc_id", "_t", "_m.*")
    have = {n: F.col(n) for n in shown}
    by_name = {r.name: r for r in rules}
    failed = F.lit(False)
    for name in base:
        failed = failed | by_name[name].rejects(have)
    return out.select("doc_id", *shown, failed.alias("base_failed"),
                      verdict(order, have, F.col("_t")).isNull().alias("kept"))


SQL = r"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
g as (select doc_id, s, array_to_string(w[s:s + 7], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 6)) as s from w where len(w) >= 8)),
r as (select doc_id, s from g qualify count(*) over (partition by doc_id, g) > 1),
c as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(s, s + 8)) as p from r) group by doc_id),
m as (select w.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, len(ls) - len(list_distinct(ls)) as n_dup_lines,
  coalesce(c.n, 0) as n_repeat_words, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_capitals,
  len(list_filter(w, lambda x: length(x) = 1)) as n_alone from w left join c using (doc_id)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 100 * n_symbols > 5 * word_chars or 100 * n_capitals > 50 * word_chars or word_chars < 2 * n_words
    or word_chars > 20 * n_words or 100 * n_alone > 50 * n_words or 5 * n_dup_lines > n_words) as kept
from b
"""
