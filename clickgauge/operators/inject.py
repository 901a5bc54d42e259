"""Labelled perturbations of a hit table, for measuring recall.

Rows are chosen by the md5 of their id instead of a random draw: the same rows are chosen on
every run and after every task retry, and the realised counts are exact.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.events import event_contains, list_ids
from ..functions.text import as_col

HEX_PREFIX = 3  # 16**3 rank buckets


@dataclass(frozen=True)
class Scenario:
    anomaly_id: str
    type: str
    metric: str
    start: str
    end: str
    magnitude: float
    dim: str | None = None
    value: str | None = None
    event_id: str | None = None

    def inside(self, day: str) -> Column:
        cond = as_col(day).between(F.lit(self.start).cast("date"), F.lit(self.end).cast("date"))
        return F.coalesce(cond, F.lit(False))


# Windows and magnitudes of the default scenarios.
DEFAULT_WINDOWS = {
    "spike": ("2026-03-10", "2026-03-10", 2.5),
    "dip": ("2026-05-20", "2026-05-21", 0.4),
    "level_shift": ("2026-04-20", "2026-05-03", 1.9),
    "dim_mix_shift": ("2026-06-10", "2026-06-12", 0.20),
    "event_drop": ("2026-03-24", "2026-03-26", 1.0),
}


def default_scenarios(dim: str, value: str, event_id: str) -> list[Scenario]:
    extra = {"dim_mix_shift": dict(dim=dim, value=value), "event_drop": dict(event_id=event_id)}
    metric = {"dim_mix_shift": f"{dim}_share", "event_drop": f"event_{event_id}_rate"}
    return [Scenario(f"{t}_{s}", t, metric.get(t, "hits"), s, e, m, **extra.get(t, {}))
            for t, (s, e, m) in DEFAULT_WINDOWS.items()]


def hash_of(id_col: str) -> Column:
    return F.md5(F.col(id_col).cast("string"))


def with_hash_rank(df: DataFrame, id_col: str) -> DataFrame:
    """Exact 1-based rank by md5, without sorting everything in one task.

    Rows are ranked inside buckets of the leading hex digits; the bucket offsets come from a
    count per bucket (4,096 rows at most, hence safe to broadcast). Also adds ``_total``, the
    number of rows, from the same counts.
    """
    df = df.withColumn("_h", hash_of(id_col)).withColumn("_b", F.substring("_h", 1, HEX_PREFIX))
    sizes = df.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(1)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                           F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_total"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_h", id_col))
    ranked = df.withColumn("_r", inside).join(F.broadcast(offsets), "_b")
    return ranked.withColumn("_rank", F.col("_r") + F.col("_offset")).drop("_h", "_b", "_r", "_offset")


def _rounded(n: Column, factor: float) -> Column:
    """Half-even rounding of n * factor to a whole number of rows."""
    return F.bround(n * F.lit(factor), 0).cast("long")


def inject_volume(df: DataFrame, sc: Scenario, day: str, id_col: str) -> DataFrame:
    """Spike or level shift: append round(n * (m - 1)) copies of window rows with fresh ids."""
    window = df.where(sc.inside(day))
    n = F.col("_total")
    extra = _rounded(n, sc.magnitude - 1)
    ranked = with_hash_rank(window, id_col)
    whole = F.floor(extra / n)
    copies = whole + F.when(F.col("_rank") <= extra - whole * n, 1).otherwise(0)
    added = (ranked.withColumn("_copies", copies).where("_copies > 0")
             .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies").cast("long"))))
             .withColumn(id_col, F.concat(F.col(id_col).cast("string"), F.lit("+"), "_copy")))
    kept = df.withColumn(id_col, F.col(id_col).cast("string"))
    return kept.unionByName(added.select(*df.columns))


def inject_dip(df: DataFrame, sc: Scenario, day: str, id_col: str) -> DataFrame:
    """Keep each window row with probability m (by hash, so no shuffle at all)."""
    bound = f"{int(round(sc.magnitude * 2 ** 32)):08x}"
    keep = F.substring(hash_of(id_col), 1, 8) < bound
    return df.where(~sc.inside(day) | keep) if sc.magnitude < 1 else df


def inject_dim_mix(df: DataFrame, sc: Scenario, day: str, id_col: str) -> DataFrame:
    """Force round(n * m) window rows to one dimension value; volume is unchanged."""
    window = df.where(sc.inside(day))
    forced = _rounded(F.col("_total"), sc.magnitude)
    ranked = with_hash_rank(window, id_col).withColumn(
        sc.dim, F.when(F.col("_rank") <= forced, F.lit(sc.value)).otherwise(F.col(sc.dim)))
    return df.where(~sc.inside(day)).unionByName(ranked.select(*df.columns))


def inject_event_drop(df: DataFrame, sc: Scenario, day: str, events: str = "post_event_list") -> DataFrame:
    """Remove one id from the event lists of the window."""
    hit = sc.inside(day) & event_contains(events, sc.event_id)
    without = F.array_join(F.array_remove(list_ids(events), sc.event_id), ",")
    return df.withColumn(events, F.when(hit, without).otherwise(F.col(events)))


def inject(df: DataFrame, sc: Scenario, day: str = "hit_date", id_col: str = "hit_id",
           events: str = "post_event_list") -> DataFrame:
    if sc.type in ("spike", "level_shift"):
        return inject_volume(df, sc, day, id_col)
    if sc.type == "dip":
        return inject_dip(df, sc, day, id_col)
    if sc.type == "dim_mix_shift":
        return inject_dim_mix(df, sc, day, id_col)
    if sc.type == "event_drop":
        return inject_event_drop(df, sc, day, events)
    raise ValueError(f"unknown scenario type: {sc.type!r}")


def realized_effect(before: DataFrame, after: DataFrame, sc: Scenario, day: str = "hit_date",
                    events: str = "post_event_list") -> DataFrame:
    """Hits, share of the forced value and event rate inside the window, before and after."""
    def measure(df, side):
        w = df.where(sc.inside(day))
        share = F.avg((F.coalesce(F.col(sc.dim) == sc.value, F.lit(False))).cast("double")) if sc.dim else F.lit(None).cast("double")
        rate = F.avg(event_contains(events, sc.event_id).cast("double")) if sc.event_id else F.lit(None).cast("double")
        return w.agg(F.count(F.lit(1)).alias("hits"), share.alias("share"), rate.alias("rate")).withColumn("side", F.lit(side))

    both = measure(before, "before").unionByName(measure(after, "after"))

    def pick(c, side):
        return F.max(F.when(F.col("side") == side, F.col(c)))

    n = both.agg(*[pick(c, s).alias(f"{c}_{s}") for c in ("hits", "share", "rate") for s in ("before", "after")])
    return n.select(
        F.lit(sc.anomaly_id).alias("anomaly_id"), "hits_before", "hits_after",
        F.round(F.try_divide(F.col("hits_after"), F.col("hits_before")), 4).alias("realized_ratio"),
        F.round("share_before", 4).alias("share_before"), F.round("share_after", 4).alias("share_after"),
        F.round((F.col("share_after") - F.col("share_before")) * 100, 2).alias("realized_delta_pp"),
        F.round("rate_before", 4).alias("rate_before"), F.round("rate_after", 4).alias("rate_after"))


def manifest(spark, scenarios: list[Scenario]) -> DataFrame:
    """Ground truth as a table (one row per scenario)."""
    from .evaluate import MANIFEST_SCHEMA
    rows = [(s.anomaly_id, s.type, s.metric, (s.dim, s.value, s.event_id), s.start, s.end, float(s.magnitude))
            for s in scenarios]
    text = MANIFEST_SCHEMA.replace("date_start date, date_end date", "date_start string, date_end string")
    return spark.createDataFrame(rows, text).withColumns(
        {c: F.col(c).cast("date") for c in ("date_start", "date_end")})
