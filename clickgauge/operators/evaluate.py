"""Recall of labelled scenarios and false-positive rates.

Windows of ground truth are expanded to days (a window is bounded by the calendar), so every
range condition becomes an equi-join that Spark can hash.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import slug
from .detect import VECTOR_METRIC

VOLUME_METRICS = ("hits_total", "visits_total", "visitors_total", VECTOR_METRIC)
SCENARIO_TYPES = ("spike", "dip", "level_shift", "dim_mix_shift", "event_drop")
MANIFEST_SCHEMA = (
    "anomaly_id string, type string, metric string, "
    "scope struct<dim: string, value: string, event_id: string>, date_start date, date_end date, magnitude double"
)


def relevant_metrics(kind: Column, scope: Column) -> Column:
    """Metrics whose flags count as detecting a scenario."""
    volume = F.array(*[F.lit(m) for m in VOLUME_METRICS])
    mix = F.array(F.concat(F.lit("pagename_share_"), slug(scope["value"])), F.lit(VECTOR_METRIC))
    event = F.array(*[F.concat(F.lit("event_"), scope["event_id"], F.lit(s)) for s in ("_count", "_rate")])
    return (F.when(kind.isin("spike", "dip", "level_shift"), volume).when(kind == "dim_mix_shift", mix)
            .when(kind == "event_drop", event)
            .otherwise(F.raise_error(F.concat(F.lit("unknown scenario type: "), kind))))


def window_days(windows: DataFrame, start: str = "date_start", end: str = "date_end") -> DataFrame:
    days = F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day")))
    return windows.withColumn("date", days)


def recall_range_join(anomalies: DataFrame, manifest: DataFrame, how: str = "inner") -> DataFrame:
    """Findings within the window and among the relevant metrics of each scenario: windows as days, metrics as
    rows, so that a range becomes a hash join. With ``how='left'`` days without a finding stay, too."""
    cells = window_days(manifest.withColumn("relevant", relevant_metrics(F.col("type"), F.col("scope"))))
    cells = cells.select(F.col("anomaly_id").alias("scenario"), "type", "date_start", "date",
                         F.explode("relevant").alias("metric_id"))
    return cells.join(anomalies.select("date", "metric_id", "detector"), ["date", "metric_id"], how)


def score_recall(anomalies: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row per scenario: detected?, by what, after how many days, how many flags."""
    found = recall_range_join(anomalies, manifest, "left")
    hit = F.col("detector").isNotNull()
    return found.groupBy("scenario", "type").agg(
        F.max(hit).alias("detected"), F.array_sort(F.collect_set("detector")).alias("detectors"),
        F.datediff(F.min(F.when(hit, F.col("date"))), F.min("date_start")).alias("delay_days"),
        F.count("detector").alias("flags_in_window"))


def excluded_days(manifest: DataFrame | None, known: DataFrame | None) -> DataFrame:
    parts = [window_days(manifest).select("date")] if manifest is not None else []
    if known is not None:
        parts.append(known.select("date"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def false_positives(anomalies: DataFrame, excluded: DataFrame) -> DataFrame:
    """Findings outside every scenario window and known date."""
    return anomalies.join(excluded, "date", "left_anti")


def score_fp(anomalies: DataFrame, denominators: DataFrame, excluded: DataFrame) -> DataFrame:
    """False positives over scored cells, per class; NULL rate for an empty denominator."""
    fp = false_positives(anomalies, excluded).groupBy("class").agg(F.count(F.lit(1)).alias("flagged_fp"))
    total = denominators.groupBy("class").agg(F.sum("denominator").alias("denominator"))
    n = F.coalesce("flagged_fp", F.lit(0))
    return total.join(fp, "class", "left").select(
        "class", n.alias("flagged_fp"), "denominator", F.round(F.try_divide(n, F.col("denominator")), 5).alias("rate"))


def control_known_events(anomalies: DataFrame, known: DataFrame,
                         metrics: Sequence[str] = VOLUME_METRICS) -> DataFrame:
    """Known real events of a clean run, and whether a volume metric flagged them."""
    flagged = anomalies.where(F.col("metric_id").isin(list(metrics))).select("date").distinct().withColumn("f", F.lit(True))
    return known.select("date").distinct().join(flagged, "date", "left").select(
        "date", F.coalesce("f", F.lit(False)).alias("flagged"))
