"""Benchmark decontamination by winnowing.

Of every six successive 5-gram hashes the least is kept as a fingerprint, in documents and benchmark
items alike, so two texts that share ten words in a row share a fingerprint at the same place of it.
Fingerprints are joined; each hit is extended to the windows of ten words that hold it, and a window
counts only if its words are those of an item. Items of fewer than ten words are one window of their own
length, for which documents list all their hashes of that length.

The join carries a row per fingerprint, but a document's words only where the benchmark side is
broadcast (its size is checked first): then hits are cut out before anything is copied. Beyond that size
each fingerprint carries its fifteen words through a shuffle.

Null and empty texts have no words, no hits, no items. Repeated rows get the same answer, one row out
for each row in; repeated items all count, under each id. Null item ids are left out of the listing.
Empty tables give no rows, or no hits. Columns besides ids and texts are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bind
from ..sources.scratch import materialize
from .common import ascii_lower, digest, positions, row_key, whole

WINDOW = 10
GRAM = 5
STEPS = WINDOW - GRAM + 1  # grams in a window
BROADCAST_ROWS = 500_000
BROADCAST_CHARS = 50_000_000
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
SEPARATORS_ANY_CASE = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, SEPARATORS_ANY_CASE), lambda w: w != "")).cast("bigint")


def _grams(w: Column, size: int) -> Column:
    """Hash of each run of ``size`` words."""
    return F.transform(positions(F.size(w) - (size - 1)), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))


def _over_six(values: Column, pick) -> Column:
    """``pick`` (least or greatest) of each element and the five after it, by doubling; nulls and the end don't count."""
    def joined(a: Column, ahead: int) -> Column:
        return F.zip_with(a, F.slice(a, F.lit(ahead + 1), F.greatest(F.size(a) - ahead, F.lit(0))), lambda x, y: pick(x, y))

    return bind(joined(values, 1), lambda two: bind(joined(two, 2), lambda four: joined(four, 2)))


def winnowed(w: Column) -> Column:
    """(at, h) of the 5-grams that are least in some run of six; none in texts under ten words."""
    def of(h: Column) -> Column:
        least = F.slice(_over_six(h, F.least), F.lit(1), F.greatest(F.size(h) - (STEPS - 1), F.lit(0)))
        # the largest of the minima whose runs hold a gram: the gram itself exactly if some run chose it
        before = F.array_repeat(F.lit(None).cast("bigint"), STEPS - 1)

        def select(best: Column) -> Column:
            chosen = F.filter(positions(F.size(h)), lambda i: F.get(h, i) == F.get(best, i))
            return F.transform(chosen, lambda i: F.struct(i.alias("at"), F.get(h, i).alias("h")))

        return bind(bind(F.concat(before, least), lambda m: _over_six(m, F.greatest)), select)

    none = F.array().cast("array<struct<at:int,h:bigint>>")
    return F.when(F.size(w) >= WINDOW, bind(_grams(w, GRAM), of)).otherwise(none)


def _short(w: Column, size: int) -> Column:
    """(at, h) of every run of ``size`` words, told apart from 5-grams and other sizes."""
    return F.transform(_grams(w, size), lambda x, i: F.struct(i.alias("at"), F.xxhash64(x, F.lit(size)).alias("h")))


def _windows(items: DataFrame) -> DataFrame:
    """(words, class, win, size): each window of each distinct item text."""
    def of(w: Column) -> Column:
        many = F.transform(positions(F.size(w) - (WINDOW - 1)), lambda i: F.array_join(F.slice(w, i + 1, F.lit(WINDOW)), " "))
        return F.when(F.size(w) >= WINDOW, F.array_distinct(many)).otherwise(F.array(F.array_join(w, " ")))

    each = items.select("words", "class", F.explode(of(F.col("words"))).alias("win"))
    return each.select("class", "win", F.least(F.size("words"), F.lit(WINDOW)).alias("size"))


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
            item_col: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """((key, start, size, class), (class, item_id)): every occurrence of an item's window in a document."""
    items = benchmark.select(F.col(item_col).alias("item_id"), words(whole(item_text)).alias("words")).where(F.size("words") > 0)
    items = materialize(items.withColumn("class", digest(F.array_join("words", " "))), "items")
    distinct = items.dropDuplicates(["class"])
    windows = materialize(_windows(distinct), "item-windows")
    sizes = sorted(r[0] for r in windows.where(F.col("size") < WINDOW).select("size").distinct().collect())  # under ten rows

    def prints(w: Column) -> Column:
        return F.concat(winnowed(w), *[_short(w, n) for n in sizes]) if sizes else winnowed(w)

    of_items = F.concat(winnowed(F.col("words")), *[
        F.when(F.size("words") == n, _short(F.col("words"), n)).otherwise(F.array().cast("array<struct<at:int,h:bigint>>")) for n in sizes])
    known = materialize(distinct.select(F.explode(of_items).alias("x")).select("x.h").distinct(), "item-prints")
    rows, chars = windows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("win")), F.lit(0))).first()
    small = known.count() <= BROADCAST_ROWS and rows <= BROADCAST_ROWS and chars <= BROADCAST_CHARS

    lead = F.greatest(F.col("at") - (STEPS - 1), F.lit(0))
    context = F.slice(F.col("words"), lead + 1, F.lit(2 * WINDOW - GRAM))
    worded = docs.select(row_key(id_col, text).alias("key"), bind(whole(text), words).alias("words"))
    listed = worded.select("key", "words", bind(F.col("words"), prints).alias("prints"))
    if small:
        hits = (listed.select("key", "words", F.explode("prints").alias("x")).select("key", "words", "x.at", "x.h")
                .join(F.broadcast(known), "h", "left_semi"))
    else:
        near = F.transform("prints", lambda x: F.struct(x["at"].alias("at"), x["h"].alias("h"), F.slice(
            F.col("words"), F.greatest(x["at"] - (STEPS - 1), F.lit(0)) + 1, F.lit(2 * WINDOW - GRAM)).alias("near")))
        hits = listed.select("key", F.explode(near).alias("x")).select("key", "x.*").join(known, "h", "left_semi")
        context = F.col("near")
    around = hits.select("key", lead.alias("lead"), context.alias("near"))

    def candidates(w: Column) -> Column:
        def of(size: int) -> Column:
            return F.transform(positions(F.size(w) - (size - 1)), lambda i: F.struct(
                i.alias("i"), F.lit(size).alias("size"), F.array_join(F.slice(w, i + 1, F.lit(size)), " ").alias("win")))
        return F.concat(*[of(n) for n in (*sizes, WINDOW)])

    spread = around.select("key", "lead", F.explode(candidates(F.col("near"))).alias("x"))
    spread = spread.select("key", (F.col("lead") + F.col("x.i")).alias("start"), F.col("x.size").alias("size"), F.col("x.win").alias("win"))
    keyed = F.broadcast(windows) if small else windows
    return spread.join(keyed, ["win", "size"]).select("key", "start", "size", "class").distinct(), items.select("class", "item_id")


def _covered(spans: Column) -> Column:
    """Number of places in the union of (start, size) spans."""
    zero = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("end"))

    def step(acc: Column, x: Column) -> Column:
        end = (x["start"] + x["size"]).cast("bigint")
        return F.struct((acc["total"] + F.greatest(end - F.greatest(acc["end"], x["start"].cast("bigint")), F.lit(0).cast("bigint"))).alias("total"),
                        F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(F.array_sort(spans), zero, step, lambda a: a["total"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: its words, those hit, the items found in it and whether it is contaminated."""
    found, ids = matches(docs, benchmark, id_col, text, item_col, item_text)
    found = materialize(found, "windows-found")
    hit = found.groupBy("key").agg(_covered(F.collect_set(F.struct("start", "size"))).alias("n_hit"))
    named = (found.select("key", "class").distinct().join(ids, "class")
             .groupBy("key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    row = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text).alias("key"), n_words(whole(text)).alias("n_words"))
    out = row.join(hit.join(named, "key", "left"), "key", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
                      digest(F.array_join(items, ",")).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without any window of an item, all columns as they came."""
    found, _ = matches(docs, benchmark, id_col, text)
    bad = materialize(found.select(F.col("key").alias("__hit_key")).distinct(), "contaminated")
    return docs.withColumn("__hit_key", row_key(id_col, text)).join(bad, "__hit_key", "left_anti").drop("__hit_key")


SQL = r"""
with low as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
dw as (select doc_id, list_filter(string_split_regex(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from low),
ilow as (select item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from benchmark),
iw as (select item_id, list_filter(string_split_regex(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from ilow),
isz as (select item_id, w, least(len(w), 10) as k from iw where len(w) > 0),
ix as (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as s from isz),
win as (select distinct item_id, k, array_to_string(w[s:s + k - 1], ' ') as g from ix),
ks as (select distinct k from win),
dx as (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as s from dw cross join ks where len(w) >= k),
dg as (select doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') as g from dx),
m as (select dg.doc_id, dg.s, dg.k, win.item_id from dg join win on dg.g = win.g and dg.k = win.k),
h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + k)) as p from m) group by doc_id),
i as (select doc_id, count(*) as n_items, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as items
  from (select distinct doc_id, item_id from m) group by doc_id)
select dw.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join h using (doc_id) left join i using (doc_id)
"""
