"""Statistical detectors over the long KPI table, all series at once.

Every window is partitioned by ``metric_id``. The table is hashed on it once and all windows
(including the weekday ones, whose keys contain it) reuse that partitioning.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import anomaly_id, log_inverse, log_transform, severity
from ..plans.registry import Event, Registry, Thresholds
from .series import rolling_means, seasonal_baseline

MAD_TO_SIGMA = 1.4826
EPS = 1e-12
VECTOR_METRIC = "mv_daily_kpi_vector"
ANOMALY_SCHEMA = (
    "anomaly_id string, detected_at string, date date, plane string, domain string, metric_id string, "
    "segment string, observed double, expected double, score double, threshold double, severity string, "
    "class string, model_uri string, detector string, reconciled boolean, status string"
)
ANOMALY_COLUMNS = [f.split()[0] for f in ANOMALY_SCHEMA.split(", ")]


def median_over(c: str | Column, w) -> Column:
    return F.percentile(c, F.lit(0.5)).over(w)


def with_robust_scale(df: DataFrame, value: str, w) -> DataFrame:
    """Adds ``_med`` and ``_scale``: 1.4826 MAD, or the population deviation if that is 0."""
    df = df.withColumn("_med", median_over(value, w))
    mad = median_over(F.abs(F.col(value) - F.col("_med")), w) * MAD_TO_SIGMA
    df = df.withColumn("_mad", mad)
    return df.withColumn("_scale", F.when(F.col("_mad") > EPS, F.col("_mad"))
                         .otherwise(F.stddev_pop(value).over(w))).drop("_mad")


def with_robust_z(df: DataFrame, value: str, w, out: str = "z") -> DataFrame:
    df = with_robust_scale(df, value, w)
    z = F.when(F.col("_scale") > EPS, (F.col(value) - F.col("_med")) / F.col("_scale")).otherwise(F.lit(0.0))
    return df.withColumn(out, F.when(F.col(value).isNotNull(), z)).drop("_med", "_scale")


def robust_z(long: DataFrame) -> DataFrame:
    return with_robust_z(long, "value", Window.partitionBy("metric_id"))


def _is_count(reg: Registry) -> Column:
    return F.col("metric_id").isin(reg.count_metrics)


def scored_region(long: DataFrame, reg: Registry, th: Thresholds = Thresholds()) -> DataFrame:
    """Adds index, transformed value ``v``, baseline and residual (NULL outside the region).

    The index counts calendar days from 0; the warm-up is its first ``start_frac`` share.
    """
    series = Window.partitionBy("metric_id")
    df = long.where(F.col("metric_id").isin([s.metric_id for s in reg.scored]))
    df = (df.withColumn("idx", F.row_number().over(series.orderBy("date")) - 1)
          .withColumn("n_days", F.count(F.lit(1)).over(series))
          .withColumn("is_constant", F.min("value").over(series) == F.max("value").over(series))
          .withColumn("v", log_transform(F.col("value"), _is_count(reg))))
    df = df.withColumn("baseline", seasonal_baseline(df, "v", th.dow_window, th.dow_min_history))
    scored = (F.col("idx") >= F.floor(F.col("n_days") * th.start_frac)) & F.col("baseline").isNotNull()
    return df.withColumn("resid", F.when(scored, F.col("v") - F.col("baseline")))


def quantile_gate(df: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """Adds ``gated``: residual in the top tail of its series, with a softer z floor."""
    tail = F.percentile(F.abs("resid"), F.lit(th.high_quantile)).over(Window.partitionBy("metric_id"))
    return df.withColumn("_q", tail).withColumn(
        "gated", (F.abs("resid") >= F.col("_q")) & (F.abs("z") >= th.quantile_z_floor)).drop("_q")


def anomaly_row(df: DataFrame, detector: str, *, cls: str, model_uri: str, observed: Column, expected: Column | None,
                score: Column | None, threshold: float | None, level: Column, segment: Column | None = None,
                metric: Column | None = None, domain: str = "web") -> DataFrame:
    """Canonical columns of a finding (``detected_at`` is stamped by the union)."""
    null = F.lit(None)
    metric = F.col("metric_id") if metric is None else metric
    return df.select(
        anomaly_id(metric, F.col("date"), F.lit(detector)).alias("anomaly_id"),
        null.cast("string").alias("detected_at"), F.col("date").cast("date").alias("date"),
        F.lit("batch-rescan").alias("plane"), F.lit(domain).alias("domain"), metric.alias("metric_id"),
        (null if segment is None else segment).cast("string").alias("segment"),
        F.round(observed.cast("double"), 4).alias("observed"),
        F.round((null if expected is None else expected).cast("double"), 4).alias("expected"),
        F.round((null if score is None else score).cast("double"), 3).alias("score"),
        F.lit(threshold).cast("double").alias("threshold"), level.alias("severity"), F.lit(cls).alias("class"),
        F.lit(model_uri).alias("model_uri"), F.lit(detector).alias("detector"),
        F.lit(False).alias("reconciled"), F.lit("open").alias("status"))


def segment_of(reg: Registry) -> Column:
    """Dimension value of the series, NULL for totals and events."""
    out = F.lit(None).cast("string")
    for s in reg.scored:
        if s.segment is not None:
            out = F.when(F.col("metric_id") == s.metric_id, s.segment).otherwise(out)
    return out


def univariate_scores(long: DataFrame, reg: Registry, th: Thresholds = Thresholds()) -> DataFrame:
    eligible = (F.col("n_days") >= th.min_history) & ~F.col("is_constant")
    df = scored_region(long, reg, th).where(eligible)
    df = quantile_gate(with_robust_z(df, "resid", Window.partitionBy("metric_id")), th)
    return df.withColumn("flagged", F.coalesce((F.abs("z") >= th.z_flag) | F.col("gated"), F.lit(False)))


def detect_univariate(long: DataFrame, reg: Registry, th: Thresholds = Thresholds(),
                      domain: str = "web") -> DataFrame:
    """Residual against the weekday baseline: large robust z, or tail of its own series."""
    flagged = univariate_scores(long, reg, th).where("flagged")
    return anomaly_row(
        flagged, "univariate", cls="business", model_uri="local:seasonal_dow_median", domain=domain,
        observed=log_inverse(F.col("v"), _is_count(reg)), expected=log_inverse(F.col("baseline"), _is_count(reg)),
        score=F.abs("z"), threshold=th.z_flag, level=severity(F.abs("z"), th.severity), segment=segment_of(reg))


def level_shift_scores(long: DataFrame, reg: Registry, th: Thresholds = Thresholds()) -> DataFrame:
    series = Window.partitionBy("metric_id")
    df = scored_region(long.where(F.col("metric_id").isin(reg.volume_metrics)), reg, th)
    df = with_robust_scale(df.where(F.col("n_days") >= th.min_history), "resid", series)
    post, pre = rolling_means(df, "v", th.ls_post_window, th.ls_pre_window)
    df = df.withColumn("post_mean", post).withColumn("pre_mean", pre)
    first = F.greatest(F.lit(th.ls_post_window + th.ls_pre_window), F.floor(F.col("n_days") * th.start_frac))
    noise = (1.0 / th.ls_post_window + 1.0 / th.ls_pre_window) ** 0.5
    df = df.where((F.col("_scale") > EPS) & (F.col("idx") >= first))
    return df.withColumn("z", (F.col("post_mean") - F.col("pre_mean")) / (F.col("_scale") * noise))


def detect_level_shift(long: DataFrame, reg: Registry, th: Thresholds = Thresholds(),
                       domain: str = "web") -> DataFrame:
    """Last week against the three weeks before it, in units of daily residual noise."""
    flagged = level_shift_scores(long, reg, th).where(F.abs("z") >= th.ls_z)
    return anomaly_row(
        flagged, "level_shift", cls="business", model_uri="local:cusum.seasonal_resid", domain=domain,
        observed=log_inverse(F.col("post_mean"), _is_count(reg)), expected=log_inverse(F.col("pre_mean"), _is_count(reg)),
        score=F.abs("z"), threshold=th.ls_z, level=severity(F.abs("z"), th.severity), segment=segment_of(reg))


def feature_matrix(long: DataFrame, reg: Registry) -> DataFrame:
    """Feature per (date, metric), still long: counts on a log scale, the rest raw."""
    scored = long.where(F.col("metric_id").isin([s.metric_id for s in reg.scored]))
    return scored.select("date", "metric_id", log_transform(F.col("value"), _is_count(reg)).alias("x"))


def tail_scores(features: DataFrame) -> DataFrame:
    """-log empirical tail probabilities of each feature value, left, right and by skew sign."""
    series = Window.partitionBy("metric_id")
    left = -F.ln(F.cume_dist().over(series.orderBy("x")))
    right = -F.ln(F.cume_dist().over(series.orderBy(F.desc("x"))))
    mean, n = F.avg("x").over(series), F.count("x").over(series)
    df = features.withColumn("u_l", left).withColumn("u_r", right).withColumn("_d", F.col("x") - mean)
    third = F.sum(F.pow("_d", F.lit(3))).over(series) / n
    df = df.withColumn("_third", third)
    skewed = (F.when(F.col("_third") < 0, F.col("u_l")).when(F.col("_third") > 0, F.col("u_r"))
              .otherwise(F.col("u_l") + F.col("u_r")))
    return df.withColumn("u_s", skewed).drop("_d", "_third")


COMBINATIONS = ("ecod", "ecod_per_feature", "copod")


def multivariate_scores(long: DataFrame, reg: Registry, method: str = "ecod") -> DataFrame:
    """Outlier score per day.

    * ``ecod``: the largest of the left, right and skew-selected *sums* (Li et al. 2022);
    * ``ecod_per_feature``: the largest of the three per feature, then summed;
    * ``copod``: per feature, the skew-selected tail or the mean of both if larger, summed.
    """
    tails = tail_scores(feature_matrix(long, reg))
    if method == "ecod":
        score = F.greatest(F.sum("u_l"), F.sum("u_r"), F.sum("u_s"))
    elif method == "ecod_per_feature":
        score = F.sum(F.greatest("u_l", "u_r", "u_s"))
    elif method == "copod":
        score = F.sum(F.greatest(F.col("u_s"), (F.col("u_l") + F.col("u_r")) / 2))
    else:
        raise ValueError(f"unknown method: {method!r}")
    return tails.groupBy("date").agg(score.alias("outlier_score"))


def detect_multivariate(long: DataFrame, reg: Registry, th: Thresholds = Thresholds(), method: str = "ecod",
                        domain: str = "web") -> DataFrame:
    """Days whose joint tail score is high (one-sided robust z over the days)."""
    days = with_robust_z(multivariate_scores(long, reg, method), "outlier_score", Window.partitionBy(F.lit(1)))
    return anomaly_row(
        days.where(F.col("z") >= th.z_flag), "multivariate", cls="business", model_uri=f"local:{method}",
        metric=F.lit(VECTOR_METRIC), observed=F.col("outlier_score"), expected=None, score=F.col("z"),
        threshold=th.z_flag, level=severity(F.col("z"), th.severity), domain=domain)


def anomaly_union(parts: Sequence[DataFrame], detected_at: str) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return (out.withColumn("detected_at", F.lit(detected_at)).select(*ANOMALY_COLUMNS)
            .orderBy("date", "metric_id", "detector"))


def fp_denominators(long: DataFrame, reg: Registry, th: Thresholds = Thresholds()) -> DataFrame:
    """Scored cells per detector and class: the denominators of the false-positive rates."""
    event_metrics = [s.metric_id for s in reg.of(Event)]
    per = long.where(F.col("metric_id").isin([s.metric_id for s in reg.scored])).groupBy("metric_id").agg(
        F.count(F.lit(1)).alias("n"), (F.min("value") == F.max("value")).alias("constant"),
        F.avg((F.col("value") > 0).cast("double")).alias("active"))
    always_on = F.col("metric_id").isin(event_metrics) & (F.col("active") >= th.min_active_frac)
    n = per.agg(
        F.max("n").alias("n_days"),
        F.count(F.when((F.col("n") >= th.min_history) & ~F.col("constant"), 1)).alias("eligible"),
        F.count(F.when(always_on, 1)).alias("always_on"))
    days = F.col("n_days")
    scored = days - F.floor(days * th.start_frac)
    cells = {
        ("business", "univariate"): F.col("eligible") * scored,
        ("business", "level_shift"): F.lit(len(reg.volume_metrics)) * scored,
        ("business", "multivariate"): days,
        ("operational", "zero_volume"): days,
        ("operational", "event_coverage"): F.col("always_on") * days,
        ("operational", "dim_coverage"): F.lit(len(reg.rule_dims)) * F.greatest(F.lit(0), days - th.blank_warmup),
    }
    rows = F.array(*[F.struct(F.lit(c).alias("class"), F.lit(d).alias("detector"), v.cast("long").alias("denominator"))
                     for (c, d), v in cells.items()])
    return n.select(F.inline(rows))


def counts_by_detector(anomalies: DataFrame) -> DataFrame:
    per_day = anomalies.groupBy("detector", "date").agg(F.count(F.lit(1)).alias("n"))
    return per_day.groupBy("detector").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("days"))
