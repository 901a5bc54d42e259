"""Table reads, schema contracts and column policy. Everything here works on metadata."""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import qcol


class SchemaContractError(ValueError):
    """The source lacks columns that later steps rely on."""


def scan_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a parquet table by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.read.table(name_or_path)


def scan_pruned(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Project early so that a thousand-column table is read as a few columns."""
    return df.select(*[qcol(c) for c in needed])


def schema_contract(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = [c for c in required if c not in set(df.columns)]
    if missing:
        raise SchemaContractError(f"source lacks required columns {missing}")
    return df


def column_policy(available: Sequence[str], required: Sequence[str], optional: Sequence[str] = (),
                  sensitive: Sequence[str] = ()) -> list[str]:
    """Required then optional names that exist, once each, never a sensitive one."""
    have, hidden = set(available), set(sensitive)
    wanted = dict.fromkeys([*required, *optional])
    return [c for c in wanted if c in have and c not in hidden]


def lookup_scan(spark: SparkSession, path: str) -> DataFrame:
    """Headerless id<TAB>label file."""
    return spark.read.csv(path, sep="\t", schema="event_id string, label string")
