"""Latest and earliest partitions from metadata, against the rows."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickgauge.operators import volume
from clickgauge.sources.partitions import PartitionedTable, extremes
from clickgauge.streaming import incremental as I

from .conftest import values

SCANS = ("FileScan", "Scan parquet", "Scan ExistingRDD", "InMemory")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def write(spark, path, days, col="day", **more):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], f"id long, {col} string")
    for name, c in more.items():
        df = df.withColumn(name, c)
    df.write.mode("overwrite").partitionBy(*more, col).parquet(path)
    return PartitionedTable(spark, path)


DAYS = [f"2024-{m:02d}-{d:02d}" for m in range(1, 11) for d in range(1, 29)]


def test_many_days_need_no_file_scan(spark, shared):
    t = write(spark, f"{shared}/t", DAYS + [None])
    target = write(spark, f"{shared}/u", DAYS[:200])
    for df in (I.watermark(t, "day"), I.freshness_gate(t, target, "day"), I.ingest_window(t, "day", 3, "2020-01-01"), volume.month_window(t, "day", 2)):
        assert not [w for w in SCANS if w in plan(df)]
    assert I.watermark(t, "day").first()[0] == DAYS[-1]
    assert I.freshness_gate(t, target, "day").first().asDict() == {"source_watermark": DAYS[-1], "target_watermark": DAYS[199], "new_data": True}
    assert str(I.ingest_window(t, "day", 3, "2020-01-01").first()[0]) == "2024-10-25"
    assert str(volume.month_window(t, "day", 2).first()["start"]) == "2024-08-01"
    assert sorted(values(volume.trailing_window(t, "day", 2), "id")) == [len(DAYS) - 3, len(DAYS) - 2, len(DAYS) - 1]
    assert extremes(t, "day").collect() == extremes(t.frame, "day").collect()


def test_null_text_number_and_odd_values(spark, shared):
    null_only = write(spark, f"{shared}/n", [None, None])
    assert I.watermark(null_only, "day").first()[0] is None and null_only.values("day") == {None}
    text = write(spark, f"{shared}/s", ["b:1/x", "a b", "é", "Z", None])
    assert text.extremes("day").collect() == extremes(text.frame, "day").collect()
    assert text.values("day") == {"b:1/x", "a b", "é", "Z", None}
    number = write(spark, f"{shared}/i", ["9", "10", "100"])
    assert tuple(number.extremes("day").first()) == (9, 100)


def test_nested_folders_empty_folders_and_leftovers(spark, shared):
    t = write(spark, f"{shared}/t", ["2024-01-01", "2024-01-02", "2024-01-03"], region=F.when(F.col("id") == 2, "x").otherwise("y"))
    assert t.partition_columns == ["region", "day"] and str(t.extremes("day").first()["last"]) == "2024-01-03"
    assert tuple(t.extremes("region").first()) == ("x", "y")
    root = write(spark, f"{shared}/e", ["2024-01-01"])
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in ("day=2024-02-01", "day=2024-03-01/_temporary"):
        p = fs.Path(f"{shared}/e/{name}")
        p.getFileSystem(conf).mkdirs(p)
    assert str(root.extremes("day").first()["last"]) == "2024-01-01"


def test_falls_back_to_rows(spark, shared):
    t = write(spark, f"{shared}/t", ["2024-01-01", "2024-01-02"])
    assert tuple(extremes(t, "id").first()) == (0, 1)
    plain = spark.createDataFrame([("2024-01-05",), (None,)], "day string")
    assert I.watermark(plain, "day").first()[0] == "2024-01-05"


def test_catalog_tables(spark, shared):
    spark.sql("drop table if exists days_by_name")
    spark.sql(f"create table days_by_name (id long, day date) using parquet partitioned by (day) location '{shared}/named'")
    spark.sql("insert into days_by_name values (1, date'2024-05-01'), (2, date'2024-05-09'), (3, null)")
    t = PartitionedTable(spark, "days_by_name")
    assert t.partition_columns == ["day"] and [str(x) for x in t.extremes("day").first()] == ["2024-05-01", "2024-05-09"]
    assert not [w for w in SCANS if w in plan(I.watermark(t, "day"))]
    spark.sql("drop table days_by_name")


@pytest.mark.parametrize("where", ["/missing", "missing/"])
def test_no_table_has_no_partitions(spark, shared, where):
    assert PartitionedTable(spark, f"{shared}{where}").partition_columns == []
