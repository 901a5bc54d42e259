"""Registration of queries and shared CTE text."""
from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources import adapters as A


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTERED: dict[str, Query] = {}

CTES = {"hits": A.hits_sql(), "ohits": A.order_hits_sql(), "phits": A.page_hits_sql()}


def with_ctes(body: str, *extra: str) -> str:
    """Prefix the adapter CTEs that the text mentions, then the extra ones."""
    text = body + " ".join(extra)
    used = [sql for name, sql in CTES.items() if re.search(rf"\b(from|join) {name}\b", text)]
    parts = used + list(extra)
    return (f"with {', '.join(parts)} {body}" if parts else body)


def query(name: str, sql: str | None = None, *ctes: str):
    """Register ``fn(spark, sf_dir)``; ``sql`` may use the adapter CTEs by name."""
    def wrap(fn):
        if name in REGISTERED:
            raise ValueError(f"{name} registered twice")
        REGISTERED[name] = Query(fn, with_ctes(sql, *ctes) if sql else None)
        return fn
    return wrap


def on_hits(name: str, sql: str | None = None, *ctes: str):
    """Register ``fn(hits)`` over the event hits."""
    def wrap(fn):
        query(name, sql, *ctes)(lambda spark, sf_dir: fn(A.event_hits(spark, sf_dir)))
        return fn
    return wrap


def on_pages(name: str, sql: str | None = None, *ctes: str):
    def wrap(fn):
        query(name, sql, *ctes)(lambda spark, sf_dir: fn(A.page_hits(spark, sf_dir)))
        return fn
    return wrap


def on_orders(name: str, sql: str | None = None, *ctes: str):
    def wrap(fn):
        query(name, sql, *ctes)(lambda spark, sf_dir: fn(A.order_hits(spark, sf_dir)))
        return fn
    return wrap
