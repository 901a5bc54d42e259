"""Every registered query equals its SQL in an independent engine."""
from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from clickgauge.catalog import REGISTERED
from clickgauge.sources.adapters import TABLES
from tools.check import compare

SF = "/root/testdata/sf0.001"
SQL = {name: q.sql for name, q in REGISTERED.items() if q.sql}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_equals_sql(spark, con, name):
    status, _, _, note = compare(spark, con, name, entry.queries()[name], SQL.get(name), SF)
    assert status == "ok", note


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "metric_id", "value"] and df.count() > 0
