"""Column helpers shared by the text operators."""
from __future__ import annotations

import os
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import bind

BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[ \\t-\\r]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def blank_separated(c: Column) -> Column:
    """The words of a text between runs of ASCII white space."""
    return bind(F.btrim(c, F.lit(BLANKS)),
                lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANK_RUN)))


def positions(n: Column) -> Column:
    """0 .. n-1; an empty array for n < 1."""
    return F.when(n >= 1, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A key by which derived rows find their document again: equal only for repeated rows."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def digest(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver did; a cluster may also install it."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", home)
    return df.mapInArrow(fn, schema)


def crc32_table_sql() -> str:
    """SQL for one row ``t``: the 256 CRC-32 values of single bytes."""
    bit = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
    return (f"select list(c order by i) as t from (select i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: {bit}) as c "
            "from (select unnest(range(256)) as i))")


def crc32_sql(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes, where the row has ``t``."""
    octet = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::bigint"
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: {octet})"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
