"""Data-quality gates and verification reports.

A gate is a one-row frame with its measurements and a verdict (PASS, WARN, REVIEW or FAIL),
computed in one aggregate. :func:`enforce` is the only action: it raises on FAIL.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_col, count_where
from .joins import combine_single_rows, zero_fill_trap

HEX64 = "^[0-9a-f]{64}$"


class DataQualityError(ValueError):
    pass


def verdict(*rules: tuple[Column, str], default: str = "PASS") -> Column:
    """First verdict whose condition holds."""
    out = F.lit(default)
    for cond, name in reversed(rules):
        out = F.when(cond, name).otherwise(out)
    return out


def enforce(gate: DataFrame) -> None:
    failed = gate.where("verdict = 'FAIL'").limit(1).collect()
    if failed:
        raise DataQualityError(str(failed[0].asDict()))


def nonnull_frac(c: str | Column) -> Column:
    return F.try_divide(F.count(as_col(c)).cast("double"), F.count(F.lit(1)))


def dq_nonempty(df: DataFrame) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("rows"))
    return n.withColumn("verdict", verdict((F.col("rows") == 0, "FAIL")))


def dq_nonnull_frac(df: DataFrame, column: str, floor: float) -> DataFrame:
    n = df.agg(nonnull_frac(column).alias("nonnull_frac"))
    return n.withColumn("verdict", verdict((F.coalesce(F.col("nonnull_frac"), F.lit(0.0)) < floor, "FAIL")))


def dq_key_cardinality(df: DataFrame, *cols: str) -> DataFrame:
    """A key of one value only makes visit counts collapse: worth a warning, not a failure.

    ``at_least`` is 0, 1 or 2: whether there are none, one or more distinct keys."""
    key = F.struct(*cols)
    n = df.agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"), F.count(F.lit(1)).alias("_n"))  # no shuffle of keys
    several = F.when(F.col("_n") == 0, 0).when(F.col("_lo").eqNullSafe(F.col("_hi")), 1).otherwise(2)
    return n.select(several.cast("long").alias("at_least")).withColumn("verdict", verdict((F.col("at_least") <= 1, "WARN")))


def dq_eligible_share(df: DataFrame, eligible: Column, low: float = 0.90, high: float = 0.98) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("rows"), count_where(eligible).alias("eligible"))
    share = F.try_divide(F.col("eligible"), F.col("rows"))
    return n.withColumn("eligible_share", share).withColumn(
        "verdict", verdict((~F.coalesce(F.col("eligible_share").between(low, high), F.lit(False)), "WARN")))


def dq_required_hosts(df: DataFrame, url: Column, hosts: Sequence[str]) -> DataFrame:
    """One row per required host; a host without rows fails."""
    n = df.select(url.alias("_url")).agg(
        *[count_where(F.col("_url").like(f"%{h.lower()}%")).alias(f"h{i}") for i, h in enumerate(hosts)])
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.col(f"h{i}").alias("rows")) for i, h in enumerate(hosts)])
    return n.select(F.inline(rows)).withColumn("verdict", verdict((F.col("rows") == 0, "FAIL")))


def dq_dead_series(long: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Named series with nothing in all history fail (a missing series as well)."""
    wide = long.agg(*[F.sum(F.when(F.col("metric_id") == m, F.col("value"))).alias(m) for m in metrics])
    rows = F.array(*[F.struct(F.lit(m).alias("metric_id"), F.coalesce(F.col(f"`{m}`"), F.lit(0.0)).alias("total"))
                     for m in metrics])
    return wide.select(F.inline(rows)).withColumn("verdict", verdict((~(F.col("total") > 0), "FAIL")))


# ---------------------------------------------------------------- verification reports

def verify_volume(df: DataFrame, day: str, min_rows: int, first_day: str | None = None,
                  days: tuple[int, int] | None = None) -> DataFrame:
    """Rows, days and interior gaps of a loaded table against its expected envelope."""
    per_day = df.groupBy(F.to_date(as_col(day)).alias("date")).agg(F.count(F.lit(1)).alias("n"))
    n = per_day.agg(F.sum("n").alias("rows_total"), F.count("date").alias("days_present"),
                    F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    n = n.withColumn("days_in_span", (F.datediff("last_day", "first_day") + 1).cast("long"))
    n = n.withColumn("gap_days", F.col("days_in_span") - F.col("days_present"))
    rules = [(F.coalesce(F.col("rows_total"), F.lit(0)) < min_rows, "FAIL")]
    if first_day:
        rules.append((F.col("first_day") != F.lit(first_day).cast("date"), "REVIEW"))
    if days:
        rules.append((~F.col("days_present").between(*days), "REVIEW"))
    return n.withColumn("verdict", verdict(*rules))


def verify_single_suite(df: DataFrame, suite: str, expected: str) -> DataFrame:
    per = df.groupBy(as_col(suite).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    n = per.agg(F.count("s").alias("distinct_suites"), F.max("s").alias("suite_seen"),
                F.coalesce(F.sum(F.when(F.col("s") != expected, F.col("n"))), F.lit(0)).alias("foreign_rows"))
    good = (F.col("distinct_suites") == 1) & (F.col("suite_seen") == expected)
    return n.withColumn("verdict", verdict((~F.coalesce(good, F.lit(False)), "FAIL")))


def verify_scope_held(df: DataFrame, url: Column, in_scope: Column, noise: Column, login: Column) -> DataFrame:
    """In-scope, blank, off-pattern, noise and login-host rows of a loaded table."""
    n = df.select(url.alias("u"), in_scope.alias("i"), noise.alias("x"), login.alias("l")).agg(
        count_where(F.col("i")).alias("in_scope_rows"),
        count_where(F.col("u") == "").alias("blank_rows"),
        count_where((F.col("u") != "") & ~F.col("i")).alias("off_pattern_rows"),
        count_where(F.col("x")).alias("noise_rows"), count_where(F.col("l")).alias("login_rows"))
    return n.withColumn("verdict", verdict(
        (F.col("login_rows") > 0, "FAIL"), (F.col("noise_rows") > 0, "REVIEW"),
        (F.col("off_pattern_rows") > 0, "REVIEW")))


def verify_domains(df: DataFrame, url: Column, required: Mapping[str, str], optional: Mapping[str, str],
                   leaks: Sequence[str]) -> DataFrame:
    """Rows per named host pattern, and rows of excluded hosts."""
    u = F.col("_url")
    leak = F.lit(False)
    for p in leaks:
        leak = leak | u.like(p)
    n = df.select(url.alias("_url")).agg(
        *[count_where(u.like(p)).alias(f"{name}_rows") for name, p in [*required.items(), *optional.items()]],
        count_where(leak).alias("leakage_rows"))
    rules = [(F.col(f"{name}_rows") == 0, "FAIL") for name in required]
    return n.withColumn("verdict", verdict(*rules, (F.col("leakage_rows") > 0, "FAIL")))


def verify_conform(raw: DataFrame, conformed: DataFrame, event_col: str, floor: float,
                   eligible: tuple[float, float] | None = None,
                   languages: Sequence[str] = (), lang_col: str = "language") -> DataFrame:
    """Conformed table against raw: equal rows, or an eligible share inside a band."""
    n = combine_single_rows(
        raw.agg(F.count(F.lit(1)).alias("raw_rows")),
        conformed.agg(F.count(F.lit(1)).alias("conformed_rows"), nonnull_frac(event_col).alias("event_list_nonnull"),
                      *[F.try_divide(count_where(as_col(lang_col) == v).cast("double"), F.count(F.lit(1))).alias(f"share_{v}")
                        for v in languages]))
    share = F.try_divide(F.col("conformed_rows"), F.col("raw_rows"))
    n = n.withColumn("conformed_share", share)
    rules = [(F.coalesce(F.col("event_list_nonnull"), F.lit(0.0)) < floor, "FAIL")]
    if eligible:
        rules.append((~F.coalesce(F.col("conformed_share").between(*eligible), F.lit(False)), "REVIEW"))
    else:
        rules.insert(0, (F.col("conformed_rows") != F.col("raw_rows"), "FAIL"))
    rules += [(F.coalesce(F.col(f"share_{v}"), F.lit(0.0)) == 0, "FAIL") for v in languages]
    return n.withColumn("verdict", verdict(*rules))


def verify_pseudonym(df: DataFrame, column: str) -> DataFrame:
    """Hashed, raw and NULL identities by shape."""
    hashed = as_col(column).rlike(HEX64)
    n = df.agg(count_where(hashed).alias("hashed_rows"), count_where(~hashed).alias("raw_rows"),
               count_where(as_col(column).isNull()).alias("null_rows"),
               F.max(F.length(as_col(column))).cast("long").alias("max_length"))
    return n.withColumn("verdict", verdict(
        ((F.col("hashed_rows") > 0) & (F.col("raw_rows") > 0), "FAIL"), (F.col("hashed_rows") == 0, "REVIEW")))


def verify_gold_shape(long: DataFrame, expected_series: int) -> DataFrame:
    """Series, days, rows and NULLs of a long KPI table."""
    per = long.groupBy("metric_id", "date").agg(F.count(F.lit(1)).alias("n"), count_where(F.col("value").isNull()).alias("nulls"))
    by_metric = per.groupBy("metric_id").agg(F.sum("n").alias("n"), F.sum("nulls").alias("nulls"),
                                             F.min("date").alias("lo"), F.max("date").alias("hi"))
    days = long.select("date").distinct().agg(F.count(F.lit(1)).alias("days_present"))
    n = combine_single_rows(days, by_metric.agg(
        F.count(F.lit(1)).alias("series_count"), F.sum("n").alias("long_rows"), F.sum("nulls").alias("null_values"),
        (F.datediff(F.max("hi"), F.min("lo")) + 1).cast("long").alias("days_in_span")))
    good = (F.col("series_count") == expected_series) & (F.col("days_present") == F.col("days_in_span"))
    return n.withColumn("verdict", verdict((F.col("null_values") > 0, "FAIL"), (~good, "REVIEW")))


def verify_pv_identity(long: DataFrame, tol: float = 1e-6) -> DataFrame:
    """Under the all-hits basis page views equal hits, and bucket shares partition the visits."""
    def value(m):
        return F.max(F.when(F.col("metric_id") == m, F.col("value")))

    per = long.groupBy("date").agg(
        value("hits_total").alias("hits"), value("page_views_total").alias("pv"), value("visits_total").alias("visits"),
        F.sum(F.when(F.col("metric_id").startswith("pv_bucket_share_"), F.col("value"))).alias("buckets"))
    n = per.agg(
        F.count(F.lit(1)).alias("days"),
        count_where(F.abs(F.col("hits") - F.col("pv")) > 1e-9).alias("basis_mismatch_days"),
        count_where((F.col("visits") > 0) & (F.abs(F.col("buckets") - 1.0) > tol)).alias("partition_violations"),
        F.avg(F.when(F.col("visits") > 0, F.try_divide(F.col("pv"), F.col("visits")))).alias("mean_pv_per_visit"))
    return n.withColumn("verdict", verdict(
        (F.col("basis_mismatch_days") > 0, "FAIL"), (F.col("partition_violations") > 0, "FAIL")))


def verify_funnel_events(long: DataFrame, metrics: Sequence[str]) -> DataFrame:
    n = long.where(F.col("metric_id").isin(list(metrics))).groupBy("metric_id").agg(
        F.sum("value").alias("total"), count_where(F.col("value") > 0).alias("days_firing"),
        F.count(F.lit(1)).alias("days_present"))
    return n.withColumn("verdict", verdict((~(F.col("total") > 0), "FAIL")))


def verify_funnel_ratios(long: DataFrame, steps: Mapping[str, tuple[str, str]]) -> DataFrame:
    """History-wide ratios by name -> (numerator, denominator); above 1 is legal, but reviewed."""
    metrics = sorted({m for pair in steps.values() for m in pair})
    totals = long.where(F.col("metric_id").isin(metrics)).agg(
        *[F.sum(F.when(F.col("metric_id") == m, F.col("value"))).alias(m) for m in metrics])
    n = totals.select(*[F.try_divide(F.col(f"`{a}`"), F.col(f"`{b}`")).alias(name) for name, (a, b) in steps.items()])
    last = list(steps)[-1]
    return n.withColumn("verdict", verdict((F.col(last).isNull(), "FAIL"), (F.col(last) > 1.0, "REVIEW")))


def verify_lang_share(long: DataFrame, metrics: Sequence[str]) -> DataFrame:
    n = long.where(F.col("metric_id").isin(list(metrics))).groupBy("metric_id").agg(
        F.avg("value").alias("mean_share"), F.min("value").alias("min_share"), F.max("value").alias("max_share"))
    return n.withColumn("verdict", verdict((~(F.col("mean_share") > 0), "FAIL")))


def verify_zero_fill(long: DataFrame, hits: DataFrame, day: str) -> DataFrame:
    n = zero_fill_trap(long, hits, day).agg(
        F.count(F.lit(1)).alias("zero_days"), count_where(F.col("is_synthetic")).alias("synthetic_days"),
        count_where(~F.col("is_synthetic")).alias("genuine_days"))
    return n.withColumn("verdict", verdict((F.col("zero_days") > 0, "REVIEW")))
