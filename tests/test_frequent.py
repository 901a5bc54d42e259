"""Top values through a sketch equal full counts, and say when they cannot be proven."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickgauge.operators import census, frequent
from clickgauge.operators.series import top_per_group


@pytest.fixture(scope="module")
def table(spark):
    i = F.col("id")
    rare = F.xxhash64("id").cast("string")
    return spark.range(60_000).repartition(6).select(
        F.when(i % 3 > 0, F.concat(F.lit("common"), (F.log2(i % 4000 + 1)).cast("int"))).otherwise(rare).alias("skewed"),
        rare.alias("unique"), F.concat(F.lit("t"), i % 3000).alias("tied"), (i % 7).cast("string").alias("few"),
        F.when(i % 2 == 0, F.lit(" ")).when(i % 5 == 0, F.lit("é")).alias("blanks"), F.lit(None).cast("string").alias("none"))


def rows(df):
    return sorted((r["name"], r["rank"], r["value"], r["n"]) for r in df.collect())


@pytest.mark.parametrize("k", [1, 5, 40])
def test_equals_full_counts(table, k):
    items = frequent.columns_of(table.columns)
    full = top_per_group(frequent.exact_counts(table, items), "name", k, "n", "value")
    assert rows(frequent.top_items(table, items, k, tracked=512)) == rows(full)


def test_only_unproven_columns_are_counted_in_full(table, monkeypatch):
    counted = []
    real = frequent.exact_counts
    monkeypatch.setattr(frequent, "exact_counts", lambda df, items: counted.append(sorted(items)) or real(df, items))
    frequent.top_items(table, frequent.columns_of(table.columns), 3, tracked=512).collect()
    assert counted == [["tied", "unique"]]


def test_text_shape_shuffles_a_row_a_task(table):
    """Its plan has one exchange, above a partial aggregate over all columns."""
    text = census.text_shape(table, table.columns)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange SinglePartition") == 1 and "Generate" not in text.split("Exchange SinglePartition")[1]


def test_candidates_and_recount_do_not_group_all_values(table):
    """Candidates are one row a task; counts are limited to candidates below their exchange."""
    items = frequent.columns_of(["skewed", "few"])
    text = frequent.candidates(table, items, 5)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange SinglePartition") == 1


def test_shapes_agree_with_value_counts(table):
    names = ["skewed", "tied", "few", "blanks", "none"]
    want = {r["column_name"]: r for r in census.custom_dims(table, names, 5).collect()}
    got = {r["column_name"]: r for r in census.custom_dims(table, names, 5, exact=False).collect()}
    assert set(got) == set(want) == {"skewed", "tied", "few", "blanks"}
    for c, r in got.items():
        assert r["top"] == want[c]["top"] and r["populated"] == want[c]["populated"] and r["len_max"] == want[c]["len_max"]
        assert r["len_p50"] == want[c]["len_p50"] and abs(r["len_avg"] - want[c]["len_avg"]) < 1e-9 and r["url_frac"] == want[c]["url_frac"]
        assert abs(r["distinct_values"] - want[c]["distinct_values"]) <= 0.2 * want[c]["distinct_values"] + 1


def test_no_rows(table):
    empty = table.limit(0)
    assert frequent.top_items(empty, frequent.columns_of(table.columns), 3).count() == 0
    assert frequent.top_items(table, {}, 3).count() == 0
