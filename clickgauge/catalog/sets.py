"""Sorts, limits and set operations as the pipeline uses them."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.census import top_n
from .base import on_hits, on_orders
from .kpis import VK
from .quality import visit


@on_orders("sort_by_date", "select hit_date as date, count(*) as n from ohits group by 1 order by 1")
def _(o):
    return o.groupBy(F.col("hit_date").alias("date")).agg(F.count(F.lit(1)).alias("n")).orderBy("date")


@on_hits("top_k", "select page_url, count(*) as n from hits group by 1 order by n desc, page_url nulls first limit 10")
def _(h):
    return top_n(h.groupBy("page_url").agg(F.count(F.lit(1)).alias("n")), 10, "n", "page_url")


@on_hits("distinct", f"select distinct hit_date, {VK} as visit from hits")
def _(h):
    return h.select("hit_date", visit().alias("visit")).distinct()


@on_hits("union", "select hit_id, rsid from hits where rsid = 'suite_b' union all select hit_id, rsid from hits where campaign = 'abc'")
def _(h):
    cols = ["hit_id", "rsid"]
    return h.where("rsid = 'suite_b'").select(*cols).unionByName(h.where("campaign = 'abc'").select(*cols))


@on_hits("intersect", f"select distinct {VK} as visit from hits where campaign = 'abc' and {VK} in (select {VK} from hits where rsid = 'suite_b')")
def _(h):
    v = h.withColumn("visit", visit())
    b = v.where("rsid = 'suite_b'").select("visit")
    return v.where("campaign = 'abc'").select("visit").distinct().join(b, "visit", "left_semi")


@on_hits("except", f"select distinct {VK} as visit from hits where campaign = 'abc' and {VK} not in (select {VK} from hits where rsid = 'suite_b')")
def _(h):
    v = h.withColumn("visit", visit())
    b = v.where("rsid = 'suite_b'").select("visit")
    return v.where("campaign = 'abc'").select("visit").distinct().join(b, "visit", "left_anti")
