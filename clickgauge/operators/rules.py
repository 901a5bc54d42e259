"""Deterministic operational rules."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.registry import Event, Registry, Thresholds
from ..sources.scratch import materialize
from .detect import anomaly_row


def _rule(df: DataFrame, detector: str, level: str, observed, expected=None, domain="web", **kw) -> DataFrame:
    return anomaly_row(df, detector, cls="operational", model_uri=f"local:rule.{detector}", observed=observed,
                       expected=expected, score=None, threshold=None, level=F.lit(level), domain=domain, **kw)


def rule_zero_volume(long: DataFrame, metric: str = "hits_total", domain: str = "web") -> DataFrame:
    silent = long.where((F.col("metric_id") == metric) & (F.col("value") == 0))
    return _rule(silent, "zero_volume", "critical", F.lit(0.0), domain=domain)


def rule_event_coverage(long: DataFrame, reg: Registry, th: Thresholds = Thresholds(),
                        domain: str = "web") -> DataFrame:
    """Events that fire on nearly every day, on the days they do not."""
    metrics = [s.metric_id for s in reg.of(Event)]
    active = F.avg((F.col("value") > 0).cast("double")).over(Window.partitionBy("metric_id"))
    df = long.where(F.col("metric_id").isin(metrics)).withColumn("_active", active)
    lost = df.where((F.col("_active") >= th.min_active_frac) & (F.col("value") == 0))
    return _rule(lost, "event_coverage", "critical", F.lit(0.0), domain=domain)


def dim_day_counts(hits: DataFrame, day: str, dims: Sequence[str]) -> DataFrame:
    """(dim, date, value, n) for all dimensions in one pass; NULL counts as ''.

    Combined before the shuffle, so a dominant value costs one row per task and day.
    """
    text = hits.select(F.to_date(day).alias("date"), *[F.coalesce(F.col(d).cast("string"), F.lit("")).alias(d) for d in dims])
    return (text.unpivot(["date"], list(dims), "dim", "value").groupBy("dim", "date", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def with_present_index(counts: DataFrame) -> DataFrame:
    """Adds the total of the day and ``k``, the 0-based index over days that have hits."""
    order = Window.partitionBy("dim").orderBy("date")
    days = counts.groupBy("dim", "date").agg(F.sum("n").alias("total"),
                                             F.sum(F.when(F.col("value") == "", F.col("n")).otherwise(0)).alias("blank"))
    days = days.withColumn("k", F.row_number().over(order) - 1)
    return counts.join(days, ["dim", "date"]).withColumn("share", F.col("n") / F.col("total"))


def blank_shares(counts: DataFrame) -> DataFrame:
    order = Window.partitionBy("dim").orderBy("date")
    days = counts.groupBy("dim", "date").agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("value") == "", F.col("n")).otherwise(0)).alias("blank"))
    return days.select("dim", "date", (F.col("blank") / F.col("total")).alias("share"),
                       (F.row_number().over(order) - 1).alias("k"))


def rule_blank_jump(counts: DataFrame, th: Thresholds = Thresholds(), domain: str = "web") -> DataFrame:
    """Blank share well above the median of the trailing present days."""
    trailing = Window.partitionBy("dim").orderBy("date").rowsBetween(-th.trailing_days, -1)
    df = blank_shares(counts).withColumn("base", F.percentile("share", F.lit(0.5)).over(trailing))
    jumped = df.where((F.col("k") >= th.blank_warmup) & (F.col("share") - F.col("base") > th.blank_jump_pp / 100.0))
    return _rule(jumped, "dim_coverage", "major", F.col("share"), F.col("base"),
                 metric=F.concat("dim", F.lit("_blank_rate")), domain=domain)


def rule_new_value(counts: DataFrame, th: Thresholds = Thresholds(), domain: str = "web") -> DataFrame:
    """A value of some weight that none of the trailing present days had."""
    seen = Window.partitionBy("dim", "value").orderBy("k")
    indexed = with_present_index(counts).where("value <> ''")
    weighty = indexed.where(F.col("share") > th.new_value_share).select("dim", "value").distinct()  # only these can fire
    df = indexed.join(weighty, ["dim", "value"], "left_semi").withColumn("last_k", F.lag("k").over(seen))
    unseen = F.col("last_k").isNull() | (F.col("k") - F.col("last_k") > th.trailing_days)
    new = df.where((F.col("k") >= th.trailing_days) & (F.col("share") > th.new_value_share) & unseen)
    return _rule(new, "dim_coverage", "major", F.col("share"), F.lit(0.0), segment=F.col("value"),
                 metric=F.concat("dim", F.lit("_new_value")), domain=domain)


RULE_KINDS = ("zero_volume", "event_coverage", "dim_coverage")


def run_rules(long: DataFrame, hits: DataFrame, reg: Registry, th: Thresholds = Thresholds(),
              kinds: Sequence[str] = RULE_KINDS, domain: str = "web", counts: DataFrame | None = None) -> DataFrame:
    """Union of the declared rules; without stored ``counts`` the dimensions are counted from the hits, once.

    What several rules read is written first: the KPI rows of the rules on series, and the dimension counts."""
    unknown = set(kinds) - set(RULE_KINDS)
    if unknown:
        raise ValueError(f"unknown rule kinds: {sorted(unknown)}")
    parts = []
    if counts is None and {"zero_volume", "event_coverage"} <= set(kinds):
        long = materialize(long, "rule-series")
    if "zero_volume" in kinds:
        parts.append(rule_zero_volume(long, domain=domain))
    if "event_coverage" in kinds:
        parts.append(rule_event_coverage(long, reg, th, domain))
    if "dim_coverage" in kinds and reg.rule_dims:
        counts = counts if counts is not None else materialize(dim_day_counts(hits, reg.date_col, reg.rule_dims), "rule-counts")
        parts += [rule_blank_jump(counts, th, domain), rule_new_value(counts, th, domain)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
