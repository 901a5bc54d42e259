"""Column censuses: how full, how varied and how long each column is.

All columns are profiled in one scan. Exact distinct counts go through one unpivot and a
two-level group-by keyed by (column, value); the default is approximate and needs no shuffle
of values at all.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import count_where, nonblank, pct, qcol

# Census classes by populated percentage.
POPULATED_MIN_PCT = 0.1
CORE_MIN_PCT = 99.0


def batched_agg(df: DataFrame, aggs: Sequence[tuple[str, Column]], batch: int = 150,
                key: str = "name") -> DataFrame:
    """Hundreds of aggregates as a long frame: ``batch`` per aggregate operator.

    One aggregate of a thousand buffers leaves whole-stage codegen; batches of this size stay
    in it. Batches share one plan (a union), each reading only its own columns.
    """
    out = None
    for at in range(0, len(aggs), batch):
        part = aggs[at:at + batch]
        wide = df.agg(*[a.cast("double").alias(f"m{i}") for i, (_, a) in enumerate(part)])
        pairs = F.array(*[F.struct(F.lit(n).alias(key), F.col(f"m{i}").alias("value"))
                          for i, (n, _) in enumerate(part)])
        long = wide.select(F.inline(pairs))
        out = long if out is None else out.unionByName(long)
    return out


def as_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[qcol(c).cast("string").alias(c) for c in columns])


def column_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n) for the non-blank values of every column, in one pass.

    The unpivot is map-side; the group-by combines before the shuffle, so a value that fills
    a third of a column travels once per task.
    """
    long = as_text(df, columns).unpivot([], [qcol(c) for c in columns], "column_name", "value")
    return (long.where(nonblank("value")).groupBy("column_name", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def _census_batch(text: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, rows, populated, distinct_values) of some columns from one aggregate."""
    aggs, rows = [F.count(F.lit(1)).alias("_rows")], []
    for i, c in enumerate(columns):
        v = F.when(nonblank(c), qcol(c))
        aggs += [F.count(v).alias(f"f{i}"), F.approx_count_distinct(v).alias(f"d{i}")]
        rows.append(F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("rows"),
                             F.col(f"f{i}").alias("populated"), F.col(f"d{i}").alias("distinct_values")))
    return text.agg(*aggs).select(F.inline(F.array(*rows)))


def population_census(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False,
                      batch: int = 150) -> DataFrame:
    """Per column: populated rows and percentage, distinct values, class.

    Sketched: one aggregate per ``batch`` columns, reading only those columns and shuffling one
    row per task. Exact: one unpivot and a two-level group-by over (column, value).
    """
    columns = list(columns or df.columns)
    if exact:
        per = column_values(df, columns).groupBy("column_name").agg(
            F.sum("n").alias("populated"), F.count(F.lit(1)).alias("distinct_values"))
        names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
        per = names.join(per, "column_name", "left").fillna(0).withColumn("rows", df.agg(F.count(F.lit(1))).scalar())
    else:
        text = as_text(df, columns)
        per = _census_batch(text, columns[:batch])
        for at in range(batch, len(columns), batch):
            per = per.unionByName(_census_batch(text, columns[at:at + batch]))
    share = pct(F.col("populated"), F.col("rows"))
    kind = (F.when(F.col("populated") == 0, "dead").when(share < POPULATED_MIN_PCT, "sparse")
            .when(share >= CORE_MIN_PCT, "core").otherwise("populated"))
    return per.select("column_name", "populated", share.alias("pop_pct"), "distinct_values", kind.alias("class"))


def with_dim_label(census: DataFrame, labels: DataFrame) -> DataFrame:
    """Label custom columns; ``labels`` is (family, number, label), e.g. ('evar', 4, ...)."""
    name = F.regexp_extract("column_name", "^(?:post_)?(evar|prop)([0-9]+)$", 1)
    number = F.regexp_extract("column_name", "^(?:post_)?(evar|prop)([0-9]+)$", 2).try_cast("int")
    keyed = census.withColumn("family", name).withColumn("number", number)
    return keyed.join(labels, ["family", "number"], "left").drop("family", "number")


def top_n(df: DataFrame, n: int, by: str = "n", *tie: str) -> DataFrame:
    """Largest ``n`` rows with an explicit tie-break (a distributed top-k, not a full sort)."""
    return df.orderBy(F.desc(by), *tie).limit(n)


def with_distincts(df: DataFrame, aggs: Sequence[Column], distincts: Mapping[str, Column], exact: bool = False,
                   keys: Mapping[str, Column] | None = None) -> DataFrame:
    """Aggregates per ``keys`` together with distinct counts of several values.

    Sketched counts go into the same aggregate. Exact ones are two-level: each value is a tagged row,
    reduced to distinct (keys, tag, value) before and after its shuffle and then counted, so no wide
    aggregate is expanded and no set of values is held in one task.
    """
    keys = dict(keys or {})
    by = [c.alias(n) for n, c in keys.items()]
    if not exact:
        return df.groupBy(*by).agg(*aggs, *[F.approx_count_distinct(c).alias(n) for n, c in distincts.items()])
    base = df.groupBy(*by).agg(*aggs)
    tagged = F.array(*[F.struct(F.lit(n).alias("_tag"), c.cast("string").alias("_value")) for n, c in distincts.items()])
    values = df.select(*by, F.inline(tagged)).where("_value is not null").distinct()
    counted = values.groupBy(*keys).agg(*[count_where(F.col("_tag") == n).alias(n) for n in distincts])
    names = [c for c in base.columns if c not in keys]
    both = base.withColumn("_base", F.lit(1)).unionByName(counted, allowMissingColumns=True)
    return (both.groupBy(*keys).agg(*[F.first(f"`{c}`", ignorenulls=True).alias(c) for c in names],
                                    *[F.coalesce(F.max(f"`{n}`"), F.lit(0)).alias(n) for n in distincts], F.max("_base").alias("_base"))
            .where("_base = 1").drop("_base"))


def top_values(df: DataFrame, column: str, n: int = 25, where: Column | None = None, sketched: bool = False) -> DataFrame:
    """Most frequent non-blank values with their share of all rows; ``sketched`` finds them, as exact, without a shuffle of all values."""
    if where is not None:
        df = df.where(where)
    if sketched:
        from .frequent import columns_of, top_items
        every = df.agg(F.count(F.lit(1))).scalar()
        return top_items(df, columns_of([column]), n).select("value", "n", pct(F.col("n"), every).alias("pct"))
    rows = df.groupBy(qcol(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.sum("n")).scalar()
    top = top_n(rows.where(nonblank("value")), n, "n", "value")
    return top.withColumn("pct", pct(F.col("n"), total))


# Column families by name.
COLUMN_FAMILIES = {
    "custom_vars": r"^(post_)?(evar|prop)[0-9]+$|^(post_)?campaign$",
    "identity": r"visid|cust_id|userid|username|cookie",
    "geo": r"^geo_|zip|country|region|city",
    "time": r"time|date|_gmt$|^ts$",
    "mobile": r"^mobile",
    "url": r"url|referrer|href",
}


def column_families(census: DataFrame, families: dict[str, str] = COLUMN_FAMILIES) -> DataFrame:
    """Columns and populated columns per name family; a name may belong to several."""
    tags = F.array_compact(F.array(*[F.when(F.lower("column_name").rlike(p), F.lit(name))
                                     for name, p in families.items()]))
    tagged = census.select("column_name", "populated", F.explode(
        F.when(F.size(tags) > 0, tags).otherwise(F.array(F.lit("other")))).alias("family"))
    return tagged.groupBy("family").agg(
        F.count(F.lit(1)).alias("columns"), count_where(F.col("populated") > 0).alias("populated_columns"))


def _value_stats(values: DataFrame) -> DataFrame:
    """Length statistics per column from (column_name, value, n), weighted by n."""
    length, n = F.length("value"), F.col("n")
    url = F.sum(F.when(F.col("value").startswith("http"), n).otherwise(0))
    stats = values.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_values"), F.sum("n").alias("populated"),
        F.percentile(length, F.lit(0.5), n).alias("len_p50"), (F.sum(length * n) / F.sum("n")).alias("len_avg"),
        F.max(length).alias("len_max"), (url / F.sum("n")).alias("url_frac"))
    return stats.withColumn("looks_like_url", F.col("url_frac") > 0.5).withColumn("free_text", F.col("len_avg") > 80)


def text_shape(df: DataFrame, columns: Sequence[str], distinct: bool = False) -> DataFrame:
    """Length and content shape of text columns, from one aggregate: a task shuffles one row, whatever the values.

    ``distinct`` adds a sketched count of distinct values and the number of populated rows. Columns without values have no row."""
    aggs, rows = [], []
    for i, c in enumerate(columns):
        v = F.when(nonblank(c), qcol(c).cast("string"))
        length, n = F.length(v), F.col(f"n{i}")
        aggs += [F.count(v).alias(f"n{i}"), F.percentile(length, F.lit(0.5)).alias(f"p{i}"), F.sum(length).alias(f"s{i}"), F.max(length).alias(f"m{i}"),
                 F.count(F.when(v.startswith("http"), 1)).alias(f"u{i}"), *([F.approx_count_distinct(v).alias(f"d{i}")] if distinct else [])]
        rows.append(F.struct(F.lit(c).alias("column_name"), n.alias("populated"), *([F.col(f"d{i}").alias("distinct_values")] if distinct else []),
                             F.col(f"p{i}").alias("len_p50"), F.try_divide(F.col(f"s{i}"), n).alias("len_avg"), F.col(f"m{i}").alias("len_max"),
                             F.try_divide(F.col(f"u{i}").cast("double"), n).alias("url_frac")))
    shape = df.agg(*aggs).select(F.inline(F.array(*rows))).where("populated > 0")
    shape = shape.withColumn("looks_like_url", F.col("url_frac") > 0.5).withColumn("free_text", F.col("len_avg") > 80)
    return shape if distinct else shape.drop("populated")


def custom_dims(df: DataFrame, columns: Sequence[str], k: int = 10, exact: bool = True) -> DataFrame:
    """Shape and top values of every custom column.

    The exact form counts every value: the value counts are its only shuffle of any size, and statistics and
    top values both read that aggregate (Spark reuses its exchange). With ``exact=False`` distinct counts are
    sketched and top values come, still exact, from the candidates of a sketch (``frequent``).
    """
    from .frequent import columns_of, top_items
    from .series import top_per_group
    entry = F.struct("rank", "value", "n")
    if not exact:
        tops = top_items(df, columns_of(columns), k).groupBy(F.col("name").alias("column_name")).agg(F.array_sort(F.collect_list(entry)).alias("top"))
        return text_shape(df, columns, distinct=True).join(tops, "column_name", "left")
    values = column_values(df, columns)
    top = top_per_group(values, "column_name", k, "n", "value")
    tops = top.groupBy("column_name").agg(F.array_sort(F.collect_list(entry)).alias("top"))
    return _value_stats(values).join(tops, "column_name", "left")


def identity_evidence(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Blank share, distinct values, lengths and degenerate flags of identity columns."""
    aggs, rows, distincts = [F.count(F.lit(1)).alias("_rows")], [], {}
    for i, c in enumerate(columns):
        v = F.when(nonblank(c), qcol(c).cast("string"))
        distincts[f"d{i}"] = v
        aggs += [F.count(v).alias(f"f{i}"), F.min(F.length(v)).alias(f"lo{i}"),
                 F.avg(F.length(v)).alias(f"av{i}"), F.max(F.length(v)).alias(f"hi{i}")]
        rows.append(F.struct(
            F.lit(c).alias("column_name"), pct(F.col("_rows") - F.col(f"f{i}"), F.col("_rows")).alias("blank_pct"),
            F.col(f"d{i}").alias("distinct_values"), F.col(f"lo{i}").alias("len_min"), F.col(f"av{i}").alias("len_avg"),
            F.col(f"hi{i}").alias("len_max"), (F.col(f"f{i}") == 0).alias("all_null"),
            (F.col(f"d{i}") == 1).alias("cardinality_1")))
    return with_distincts(df, aggs, distincts, exact).select(F.inline(F.array(*rows)))


def group_nonblank_rates(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Rows and non-blank rate of many columns per group; absent columns give NULL."""
    have = set(df.columns)
    rates = [(F.avg(F.when(nonblank(c), 1.0).otherwise(0.0)) if c in have else F.lit(None).cast("double")).alias(c)
             for c in columns]
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), *rates)


def delimiter_probe(df: DataFrame, column: str, candidates: Sequence[str], parts: int = 3) -> DataFrame:
    """How each candidate delimiter splits a tag, all in one pass; ``best`` marks the winner."""
    from pyspark.sql import Window

    from ..functions.text import split_literal
    aggs, rows = [], []
    for i, d in enumerate(candidates):
        n = F.size(split_literal(column, d))
        aggs += [F.avg(n).alias(f"a{i}"), F.avg((n == parts).cast("double")).alias(f"e{i}")]
        rows.append(F.struct(F.lit(d).alias("delimiter"), F.col(f"a{i}").alias("avg_parts"), F.col(f"e{i}").alias("exact_share")))
    out = df.where(nonblank(column)).agg(*aggs).select(F.inline(F.array(*rows)))
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("exact_share"), F.desc("avg_parts"), "delimiter")
    return out.withColumn("best", F.row_number().over(order) == 1)
