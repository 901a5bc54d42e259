"""Work at visit grain on the bucketed table: no shuffle of hits, equal results, hot keys split."""
from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from clickgauge.operators import joins as J
from clickgauge.sources.visits import VISIT, VisitTable


@pytest.fixture(scope="module")
def hits(spark):
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit("hot")).when(i % 97 == 0, F.lit("")).when(i % 89 == 0, F.lit(None)).otherwise(F.concat(F.lit("v"), i % 4001))
    return spark.range(30_000).repartition(4).select(
        i.alias("hit"), key.cast("string").alias("k"), F.concat(F.lit("2024-01-0"), i % 5 + 1).cast("date").alias("d"), (i % 11 == 0).alias("a"), (i % 7 == 0).alias("b"))


@pytest.fixture(params=[10**9, 1000], ids=["no hot key", "one hot key"])
def table(spark, shared, hits, request):
    t = VisitTable(spark, f"visits_test_{request.param}", "d")
    spark.sql(f"drop table if exists {t.name}")
    t.write(hits, F.col("k"), f"{shared}/visits", buckets=6, hot_rows=request.param)
    yield t
    spark.sql(f"drop table {t.name}")


def exchanges(df):
    """Exchanges of the executed plan that move rows by key."""
    df.collect()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_results_equal_the_plain_ones(table, hits):
    keyed = hits.where("k <> ''")
    assert rows(table.qualified(F.col("a")).select("hit")) == rows(J.qualified_visits(keyed, F.col("k"), F.col("a")).select("hit"))
    assert rows(table.overlap(F.col("a"), F.col("b"))) == rows(J.visit_overlap(keyed, F.col("k"), F.col("a"), F.col("b")))
    assert rows(table.per_visit(F.count(F.lit(1)).alias("n"))) == rows(keyed.groupBy("k").agg(F.count(F.lit(1))))
    assert rows(table.daily_visits()) == rows(keyed.groupBy("d").agg(F.count_distinct("k"), F.count(F.lit(1))))
    assert [r[0] for r in table.hot_keys().collect()] == (["hot"] if table.name.endswith("_1000") else [])


def test_no_exchange_at_visit_grain(table):
    spark = table.spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with too many keys to broadcast
    try:
        if table.hot_keys().isEmpty():
            assert exchanges(table.per_visit(F.count(F.lit(1)).alias("n"))) == []
            assert exchanges(table.qualified(F.col("a"))) == []
        else:  # the hot part alone is shuffled, after it has been combined by key
            plan = table.per_visit(F.count(F.lit(1)).alias("n"))
            assert len(exchanges(plan)) == 1
            text = plan._jdf.queryExecution().executedPlan().toString()
            below = text[text.index("Exchange hashpartitioning"):].split("\n")[1]
            assert "HashAggregate" in below or "ShuffleQueryStage" in below
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_days_are_replaced(table, hits, shared):
    later = hits.where("d >= '2024-01-03' and d <> '2024-01-05'").withColumn("a", F.lit(True))
    hot = 10**9 if table.name.endswith(str(10**9)) else 100_000  # hot before, not in this window: stays hot
    table.write(later, F.col("k"), shared, "2024-01-03", hot_rows=hot)
    want = hits.where("d < '2024-01-03'").unionByName(later).where("k <> ''")
    assert rows(table.per_visit(F.count(F.lit(1)).alias("n"), F.bool_or("a").alias("a"))) == rows(want.groupBy("k").agg(F.count(F.lit(1)), F.bool_or("a")))
    assert rows(table.spark.table(table.name).select("hit", VISIT)) == rows(want.select("hit", "k"))
