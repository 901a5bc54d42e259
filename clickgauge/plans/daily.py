"""The daily run: scope, conform, KPIs, detection, publication.

Each stage is a lazy plan between two tables, and every write can be repeated. A run counts as done
when its row is in the meta table, written last, with the source's watermark: the next run starts from
there, whatever tables a failed one has touched since, and so completes it. Bronze, silver, KPI and
dimension tables are partitioned by day and rewritten from the window's first day on; only the meta
and the anomaly table are as long as history in rows, and both are small.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.events import event_list_normalize
from ..functions.keys import pseudonymize
from ..functions.predicates import Scope, hit_eligible
from ..functions.time import event_ts_safe
from ..functions.url import host_path, lang_from_host, url_coalesce, url_host
from ..operators import detect, dq, rules
from ..sources import scan, sinks
from ..sources.partitions import PartitionedTable, Source, as_frame
from ..sources.scratch import materialize
from ..streaming.incremental import freshness_gate, ingest_window, partition_pred
from .builder import kpi_long, kpi_wide
from .registry import Event, PageBucket, Ratio, Registry, Share, Thresholds


@dataclass(frozen=True)
class Feed:
    """Everything the run needs to know about a source."""

    name: str
    scope: Scope
    registry: Registry
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    sensitive: tuple[str, ...] = ()
    identity: tuple[str, ...] = ("mcvisid", "post_visid_high", "post_visid_low")
    url_cols: tuple[str, ...] = ("page_url", "post_page_url")
    local_col: str = "date_time"
    epoch_col: str = "hit_time_gmt"
    events: str = "post_event_list"
    check_eligibility: bool = False
    lang_hosts: tuple[tuple[str, str], ...] = ()
    overlap_days: int = 3
    start_date: str = "2024-01-01"
    nonnull_floor: float = 0.95
    eligible_band: tuple[float, float] = (0.90, 0.98)
    dead_series: tuple[str, ...] = ()
    required_hosts: tuple[str, ...] = ()  # a back-fill fails without a hit on each
    skip_synthetic: bool = False  # leave zero-filled days out of detection

    @property
    def day(self) -> str:
        return self.registry.date_col


def bronze(source: DataFrame, feed: Feed, start: str | None = None) -> DataFrame:
    """Scoped, pruned mirror of the source; the window predicate comes first, so that it
    prunes partitions."""
    scan.schema_contract(source, feed.required)
    if start is not None:
        source = source.where(partition_pred(source, feed.day, start))
    cond, _ = feed.scope.condition(source)
    return source.where(cond).select(*scan.column_policy(source.columns, feed.required, feed.optional, feed.sensitive))


def silver(raw: DataFrame, feed: Feed, key: str | None) -> DataFrame:
    """Conformed hits: eligible, with a timestamp, bare event ids, pseudonyms and language.

    ``key=None`` lands identities in the clear (an explicit choice of the caller).
    """
    df = raw.where(hit_eligible()) if feed.check_eligibility else raw
    cols: dict[str, Column] = {"event_ts": event_ts_safe(feed.local_col, feed.epoch_col),
                               feed.events: event_list_normalize(feed.events)}
    if feed.lang_hosts:
        cols["language"] = lang_from_host(url_coalesce(*[c for c in feed.url_cols if c in df.columns]), dict(feed.lang_hosts))
    if key is not None:
        cols.update({c: pseudonymize(c, key) for c in feed.identity if c in df.columns})
    df = df.withColumns(cols)
    spent = [feed.local_col, feed.epoch_col] + (["exclude_hit", "hit_source", *feed.url_cols] if feed.check_eligibility else [])
    return df.drop(*spent)


def silver_gates(raw: DataFrame, conformed: DataFrame, feed: Feed) -> list[DataFrame]:
    gates = [dq.dq_nonempty(conformed), dq.dq_nonnull_frac(conformed, feed.events, feed.nonnull_floor),
             dq.dq_key_cardinality(conformed, "post_visid_high", "post_visid_low")]
    if feed.check_eligibility:
        gates.append(dq.dq_eligible_share(raw, hit_eligible(), *feed.eligible_band))
    return gates


def gold(hits: DataFrame, feed: Feed, first_day: str | None = None) -> DataFrame:
    return kpi_long(kpi_wide(hits, feed.registry, first_day))


def calendar_start(long: DataFrame | None, start: str) -> str | None:
    """First day that a rebuild from ``start`` on must hold, so that no gap opens to the days before it.

    None if there are no such days: the calendar then begins with the first hit."""
    if long is None:
        return None
    last = long.where(F.col("date") < F.lit(start).cast("date")).agg(F.date_add(F.max("date"), 1).cast("string")).first()[0]
    return min(last, start) if last else None


def findings(long: DataFrame, hits: DataFrame, feed: Feed, detected_at: str, th: Thresholds = Thresholds(),
             method: str = "ecod", counts: DataFrame | None = None) -> DataFrame:
    """All detectors and rules over the written KPI table; ``counts`` are stored dimension counts per day."""
    reg = feed.registry
    if feed.skip_synthetic:
        present = long.where((F.col("metric_id") == "hits_total") & (F.col("value") > 0)).select("date")
        long = long.join(present, "date", "left_semi").select(*long.columns)
    parts = [detect.detect_univariate(long, reg, th, feed.name), detect.detect_level_shift(long, reg, th, feed.name),
             detect.detect_multivariate(long, reg, th, method, feed.name),
             rules.run_rules(long, hits, reg, th, domain=feed.name, counts=counts)]
    return detect.anomaly_union(parts, detected_at)


def run_meta(anomalies: DataFrame, long: DataFrame, feed: Feed, run_id: str, method: str = "ecod",
             th: Thresholds = Thresholds()) -> DataFrame:
    """One row per run; counts and denominators as maps (both have one entry per detector)."""
    from ..operators.joins import combine_single_rows

    def entries(key, value):
        return F.array_sort(F.collect_list(F.struct(F.col(key).alias("key"), F.col(value).cast("long").alias("value"))))

    counts = detect.counts_by_detector(anomalies)
    den = detect.fp_denominators(long, feed.registry, th)
    row = combine_single_rows(
        long.agg(F.min("date").alias("date_min"), F.max("date").alias("date_max"),
                 (F.datediff(F.max("date"), F.min("date")) + 1).alias("n_days")),
        anomalies.agg(F.count(F.lit(1)).alias("n_anomalies")),
        counts.agg(entries("detector", "rows").alias("counts")),
        den.agg(entries("detector", "denominator").alias("denominators")))
    return row.select(F.lit(run_id).alias("run_id"), F.lit(feed.name).alias("domain"), F.lit(method).alias("method"),
                      "n_days", "date_min", "date_max", "n_anomalies",
                      F.map_from_entries("counts").alias("counts_by_detector"),
                      F.map_from_entries("denominators").alias("denominators"))


@dataclass(frozen=True)
class Tables:
    bronze: str
    silver: str
    gold: str
    dims: str
    anomalies: str
    meta: str

    @classmethod
    def under(cls, base: str) -> "Tables":
        return cls(*[f"{base}/{n}" for n in ("bronze", "silver", "gold", "dims", "anomalies", "meta")])


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if sinks.path_exists(spark, path) else None


def _done(spark: SparkSession, tables: Tables, day: str) -> DataFrame | None:
    """The source watermarks of the runs that came to their end."""
    meta = _read(spark, tables.meta)
    return None if meta is None else meta.select(F.col("source_watermark").cast("date").alias(day))


def daily_run(source: Source, feed: Feed, tables: Tables, run_id: str, key: str | None,
              mode: str = "incremental", detected_at: str | None = None, th: Thresholds = Thresholds()) -> bool:
    """One run; False when the gate finds nothing new. Only one-row results reach the driver.

    A ``PartitionedTable`` as source lets the gate decide from partition names."""
    frame = as_frame(source)
    spark = frame.sparkSession
    done = _done(spark, tables, feed.day)
    gate = freshness_gate(source, done, feed.day, mode).first()
    if not gate["new_data"]:
        return False
    start = str(ingest_window(done, feed.day, feed.overlap_days, feed.start_date, mode, spark).first()["start"])
    sinks.windowed_overwrite(bronze(frame, feed, start), tables.bronze, feed.day, start)

    raw = spark.read.parquet(tables.bronze)
    raw = raw.where(partition_pred(raw, feed.day, start))
    conformed = _conformed(raw, feed, key, mode)
    sinks.windowed_overwrite(conformed, tables.silver, feed.day, start)

    hits = spark.read.parquet(tables.silver)
    window = hits.where(partition_pred(hits, feed.day, start))
    first_day = calendar_start(_read(spark, tables.gold), start)
    sinks.windowed_overwrite(gold(window, feed, first_day), tables.gold, "date", first_day or start)
    if feed.registry.rule_dims:
        sinks.windowed_overwrite(rules.dim_day_counts(window, feed.day, feed.registry.rule_dims), tables.dims, "date", start)
    _publish(spark, feed, tables, run_id, mode, detected_at, th, gate["source_watermark"])
    return True


def changed_run(source: Source, feed: Feed, tables: Tables, days: Sequence[str], run_id: str, key: str | None,
                detected_at: str | None = None, th: Thresholds = Thresholds()) -> bool:
    """Process the named days ('YYYY-MM-DD') anew, however old; False when ``run_id`` has been published before.

    Only the partitions of these days are read and rewritten, in every table, and calendar days between them
    and the days known so far that have become part of the calendar. A repeat after a death gives the same tables."""
    frame = as_frame(source)
    spark = frame.sparkSession
    meta = _read(spark, tables.meta)
    if not days or meta is not None and not meta.where(F.col("run_id") == run_id).isEmpty():
        return False
    days = sorted(set(days))

    def of_days(df: DataFrame, *more: str) -> DataFrame:
        kind = dict(df.dtypes)[feed.day]
        return df.where(F.col(feed.day).isin([F.lit(d).cast(kind) for d in (*days, *more)]))

    sinks.days_overwrite(bronze(of_days(frame), feed), tables.bronze, feed.day, days)
    raw = of_days(spark.read.parquet(tables.bronze))
    sinks.days_overwrite(_conformed(raw, feed, key, "incremental", maybe_empty=True), tables.silver, feed.day, days)

    known = [str(d) if d else None for d in PartitionedTable(spark, tables.gold).extremes("date").first()] if sinks.path_exists(spark, tables.gold) else [None, None]
    last = PartitionedTable(spark, tables.silver).extremes(feed.day).first()["last"]
    hits = spark.read.parquet(tables.silver)
    # The last day with hits keeps the calendar of this window as long as that of the table.
    long = gold(of_days(hits, *([str(last)] if last else [])), feed, min(days[0], known[0] or days[0]))
    changed = F.col("date").cast("string").isin(days)
    if known[0]:
        changed = changed | (F.col("date") < F.lit(known[0]).cast("date")) | (F.col("date") > F.lit(known[1]).cast("date"))
    rows = materialize(long.where(changed), "gold-days")
    sinks.days_overwrite(rows, tables.gold, "date", sorted({*days, *[str(r[0]) for r in rows.select("date").distinct().collect()]}))
    if feed.registry.rule_dims:
        sinks.days_overwrite(rules.dim_day_counts(of_days(hits), feed.day, feed.registry.rule_dims), tables.dims, "date", days)
    _publish(spark, feed, tables, run_id, "incremental", detected_at, th, days[-1])
    return True


def _conformed(raw: DataFrame, feed: Feed, key: str | None, mode: str, maybe_empty: bool = False) -> DataFrame:
    """Conformed hits, written once, that have passed their gates."""
    conformed = materialize(silver(raw, feed, key), "conformed")
    if not (maybe_empty and conformed.isEmpty()):  # a changed day may lie out of scope
        for check in silver_gates(raw, conformed, feed):
            dq.enforce(check)
    if mode == "backfill" and feed.required_hosts:
        host = url_host(host_path(url_coalesce(*[c for c in feed.url_cols if c in raw.columns])))
        dq.enforce(dq.dq_required_hosts(raw, host, feed.required_hosts))
    return conformed


def _publish(spark: SparkSession, feed: Feed, tables: Tables, run_id: str, mode: str, detected_at: str | None, th: Thresholds, watermark: str) -> None:
    """Detection over the KPI table, the anomaly table and, last, the run's row."""
    hits = spark.read.parquet(tables.silver)
    long = spark.read.parquet(tables.gold).select("date", "metric_id", "value")
    if mode == "backfill" and feed.dead_series:
        dq.enforce(dq.dq_dead_series(long, feed.dead_series))
    counts = spark.read.parquet(tables.dims) if feed.registry.rule_dims else None
    at = detected_at or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    found = findings(long, hits, feed, at, th, counts=counts).withColumn("run_id", F.lit(run_id))
    # An anomaly's id is made of its date, so the month it lies in never changes.
    sinks.upsert_preserve(found.withColumn("month", F.year("date") * 100 + F.month("date")), tables.anomalies, by="month")
    mine = spark.read.parquet(tables.anomalies).where(F.col("run_id") == run_id)
    row = run_meta(mine, long, feed, run_id, th=th).withColumn("source_watermark", F.lit(watermark))
    sinks.append_meta(row, tables.meta)


def verification(spark: SparkSession, tables: Tables, feed: Feed, hashed: bool = True, min_rows: int = 1) -> DataFrame:
    """Every verification report that fits the feed over the tables of its runs: (report, verdict, detail as JSON)."""
    reg = feed.registry
    raw, hits = spark.read.parquet(tables.bronze), spark.read.parquet(tables.silver)
    long = spark.read.parquet(tables.gold).select("date", "metric_id", "value")
    languages = [s.metric_id for s in reg.of(Share) if s.dim == "language"]
    reports = {
        "volume": dq.verify_volume(hits, feed.day, min_rows),
        "conform": dq.verify_conform(raw, hits, feed.events, feed.nonnull_floor, feed.eligible_band if feed.check_eligibility else None),
        "gold_shape": dq.verify_gold_shape(long, len(reg.series)),
        "events": dq.verify_funnel_events(long, [s.metric_id for s in reg.of(Event)]),
        "zero_fill": dq.verify_zero_fill(long, hits, feed.day),
    }
    if hashed:
        reports["pseudonym"] = dq.verify_pseudonym(hits, reg.visitor_key[0])
    if languages:
        reports["language_share"] = dq.verify_lang_share(long, languages)
    if reg.page_view_basis == "all_hits" and reg.of(PageBucket):
        reports["page_views"] = dq.verify_pv_identity(long)
    if reg.of(Ratio):
        steps = {s.metric_id: (s.over, s.under) for s in reg.of(Ratio)}
        reports["ratios"] = dq.verify_funnel_ratios(long, steps)
    out = None
    for name, report in reports.items():
        rows = report.select(F.lit(name).alias("report"), "verdict", F.to_json(F.struct(*report.columns)).alias("detail"))
        out = rows if out is None else out.unionByName(rows)
    return out
