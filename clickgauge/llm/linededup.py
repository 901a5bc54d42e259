"""Cross-site line dedup: lines that many sites share are boilerplate and are removed.

The spread of a line is its number of distinct sites. A HyperLogLog sketch per line hash, merged by
aggregation, estimates it in one shuffle of small rows. Only lines whose estimate is within ``margin``
of the threshold get an exact distinct count, so the decision is that of exact counts while all others
never shuffle their sites. Lines of ``LONG_WORDS`` words or more are passages, not labels: they need fewer
sites. A text that is boilerplate throughout is a copy of a document: it stays whole, for near-duplicate
removal to judge. Every other text loses all its boilerplate lines.

Lines end at ``\\n`` and are compared without surrounding white space; blank lines are never removed.
Null texts count as empty and stay null. A null site counts as no site. Repeated rows get the same
result, one row out for each row in. Ties don't arise: the threshold is inclusive. An empty table gives
an empty result. Other columns pass through as they came, but for those that ``report`` adds, which take the
place of columns of the same name.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bind
from ..sources.scratch import materialize
from .common import BLANK_RUN, BLANKS, positions, row_key, whole

MIN_SITES = 10
LONG_SITES = 4
LONG_WORDS = 50
LG_K = 12  # 4,096 registers: a standard error of 1.6 %
MARGIN = 0.25  # fifteen standard errors


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _hash(line: Column) -> Column:
    """Hash of a line whose lowest bit says that the line is long."""
    long = (F.length(line) >= 2 * LONG_WORDS - 1) & (F.size(F.split(line, BLANK_RUN)) >= LONG_WORDS)
    even = F.xxhash64(line).bitwiseAND(F.lit(-2).cast("bigint"))
    return F.when(long, even.bitwiseOR(F.lit(1).cast("bigint"))).otherwise(even)


def _hashes(text: Column) -> Column:
    """Hash of each line in order, null where blank."""
    return F.transform(F.split(text, "\n"), lambda x: bind(_trimmed(x), lambda t: F.when(t != "", _hash(t))))


def boilerplate(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES, long_sites: int = LONG_SITES) -> DataFrame:
    """(h): hashes of the lines found on ``min_sites`` sites or more, long lines on ``long_sites``."""
    need = F.when(F.col("h").bitwiseAND(F.lit(1).cast("bigint")) == 1, long_sites).otherwise(min_sites)
    lines = docs.select(F.col(site).cast("string").alias("site"), F.explode(F.array_distinct(_hashes(whole(text)))).alias("h")).where(
        F.col("h").isNotNull() & F.col("site").isNotNull())
    spread = lines.groupBy("h").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"))
    likely = materialize(spread.where(F.col("sites") >= need * (1 - MARGIN)), "line-spread")
    near = likely.where(F.col("sites") <= need * (1 + MARGIN)).select("h")
    sure = likely.where(F.col("sites") > need * (1 + MARGIN)).select("h")
    if near.isEmpty():
        return materialize(sure, "boilerplate")
    exact = (lines.join(near, "h", "left_semi").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") >= need).select("h"))
    return materialize(sure.unionByName(exact), "boilerplate")


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", site: str = "source",
          min_sites: int = MIN_SITES, report: bool = True, long_sites: int = LONG_SITES) -> DataFrame:
    """The documents with ``text`` cleaned; ``report`` adds n_lines, n_boilerplate and n_removed (long)."""
    known = boilerplate(docs, text, site, min_sites, long_sites)
    keyed = docs.select(row_key(id_col, text).alias("__line_key"), F.posexplode(_hashes(whole(text))).alias("__line", "h"))
    marks = (keyed.where(F.col("h").isNotNull()).join(known, "h", "left_semi")
             .groupBy("__line_key").agg(F.collect_set("__line").alias("__marked")))
    marked = docs.withColumn("__line_key", row_key(id_col, text)).join(marks, "__line_key", "left").drop("__line_key")

    def clean(lines: Column) -> Column:
        kept = bind(F.array_except(positions(F.size(lines)), F.col("__marked")),
                    lambda at: F.transform(at, lambda i: F.get(lines, i)))
        return bind(kept, lambda k: F.when(F.exists(k, lambda x: _trimmed(x) != ""), F.array_join(k, "\n")))

    lines = F.split(whole(text), "\n")
    made = marked.withColumn("__clean", F.when(F.col("__marked").isNotNull(), bind(lines, clean)))
    if report:
        marks_n = F.when(F.col("__marked").isNull(), F.lit(0)).otherwise(F.size("__marked")).cast("bigint")
        made = (made.withColumn("n_lines", F.size(F.filter(lines, lambda x: _trimmed(x) != "")).cast("bigint")).withColumn("n_boilerplate", marks_n)
                .withColumn("n_removed", F.when(F.col("__clean").isNull(), F.lit(0).cast("bigint")).otherwise(F.col("n_boilerplate"))))
    return made.withColumn(text, F.coalesce("__clean", F.col(text))).drop("__clean", "__marked")


SQL = rf"""
with d as (select doc_id, source, text, string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select doc_id, source, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as pos from d),
n as (select *, trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) as t from l),
b as (select t from n where t <> '' group by t having count(distinct source) >=
  case when len(string_split_regex(t, '[ \t-\r]+')) >= {LONG_WORDS} then {LONG_SITES} else {MIN_SITES} end),
m as (select n.*, b.t is not null as boil from n left join b on n.t = b.t),
g as (select doc_id, count(*) filter (where t <> '') as n_lines, count(*) filter (where boil) as n_boilerplate,
  count(*) filter (where not boil and t <> '') as n_own,
  string_agg(line, chr(10) order by pos) filter (where not boil) as kept from m group by doc_id)
select d.doc_id, g.n_lines, g.n_boilerplate,
  case when g.n_boilerplate > 0 and n_own > 0 then g.n_boilerplate else 0 end as n_removed,
  case when g.n_boilerplate > 0 and n_own > 0 then coalesce(kept, '') else d.text end as text
from d join g using (doc_id)
"""
