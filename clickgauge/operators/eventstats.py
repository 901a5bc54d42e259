"""Event decoding, event series and funnels."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.events import event_contains, event_presence, event_tokens, raw_tokens
from ..functions.keys import count_flag, flag_words, or_words
from ..functions.text import as_col, count_where, pct, share_where
from .census import top_n
from .series import top_per_group


def event_freq(df: DataFrame, events: str, k: int = 40) -> DataFrame:
    """Per id: hits carrying it, instances, instances with a value, mean and largest value.

    One explode and one map-side combined shuffle: a token also counts towards presence when
    it is the first one of its id in the hit.
    """
    toks = df.select(event_tokens(events).alias("toks")).withColumn("ids", F.transform("toks", lambda t: t["id"]))
    each = toks.select("ids", F.posexplode("toks").alias("pos", "t")).select(
        F.col("t.id").alias("event_id"), F.col("t.value").alias("value"),
        (F.array_position("ids", F.col("t.id")) == F.col("pos") + 1).alias("is_first"))
    rows = each.groupBy("event_id").agg(
        count_where(F.col("is_first")).alias("hits_with"), F.count(F.lit(1)).alias("instances"),
        F.count("value").alias("with_value"), F.avg("value").alias("value_mean"), F.max("value").alias("value_max"))
    hits = df.agg(F.count(F.lit(1))).scalar()
    return top_n(rows, k, "hits_with", "event_id").withColumn("hits_with_pct", pct(F.col("hits_with"), hits))


def events_per_hit(df: DataFrame, events: str) -> DataFrame:
    n = df.select(F.size(raw_tokens(events)).alias("n"))
    p = F.percentile_approx("n", [0.5, 0.95])
    return n.agg(F.count(F.lit(1)).alias("hits"), count_where(F.col("n") > 0).alias("hits_with_events"),
                 p.alias("p"), F.max("n").alias("max_events")).select(
        "hits", "hits_with_events", pct(F.col("hits_with_events"), F.col("hits")).alias("pct_with_events"),
        F.col("p")[0].alias("p50"), F.col("p")[1].alias("p95"), "max_events")


def ts_events(df: DataFrame, day: str, events: str, ids: Sequence[str]) -> DataFrame:
    """Daily hits carrying each id, one column per id (ids are given, so no value scan)."""
    present = df.select(F.to_date(as_col(day)).alias("date"), event_presence(events).alias("ids"))
    return present.groupBy("date").agg(*[count_where(F.array_contains("ids", i)).alias(i) for i in ids])


def top_event_ids(df: DataFrame, events: str, k: int) -> DataFrame:
    ids = df.select(F.explode(event_presence(events)).alias("event_id")).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    return top_n(ids, k, "n", "event_id")


def ts_events_top(df: DataFrame, day: str, events: str, k: int, forced: Sequence[str] = ()) -> DataFrame:
    """Long daily series of the ``k`` most frequent ids, plus forced ids whatever their rank.

    The ranked ids stay a frame (``k`` rows) joined in the plan; nothing is collected.
    """
    ranked = top_event_ids(df, events, k).select("event_id")
    if forced:
        extra = df.sparkSession.createDataFrame([(i,) for i in forced], "event_id string")
        ranked = ranked.unionByName(extra).distinct()
    daily = (df.select(F.to_date(as_col(day)).alias("date"), F.explode(event_presence(events)).alias("event_id"))
             .groupBy("date", "event_id").agg(F.count(F.lit(1)).alias("hits")))
    return daily.join(F.broadcast(ranked), "event_id", "left_semi")


def event_rate_by_group(df: DataFrame, group: str, events: str, event_id: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"),
                                 share_where(event_contains(events, event_id)).alias("rate"))


def event_census_by_group(df: DataFrame, group: str, events: str, k: int) -> DataFrame:
    """Most frequent ids per group, counted by occurrence."""
    ids = df.select(group, F.explode(F.transform(event_tokens(events), lambda t: t["id"])).alias("event_id"))
    n = ids.where("event_id <> ''").groupBy(group, "event_id").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(n, group, k, "n", "event_id")


def _carrying(df: DataFrame, events: str, ids: Sequence[str], *cols: Column) -> DataFrame:
    """One row per hit and tracked id it carries; other ids are dropped before the explode."""
    wanted = F.array_intersect(event_presence(events), F.array(*[F.lit(i) for i in ids]))
    return df.select(*cols, F.explode(wanted).alias("event_id"))


def funnel_summary(df: DataFrame, day: str, visit: Column, events: str, steps: dict[str, str]) -> DataFrame:
    """Per step: hits, distinct visits, share of hits, active days, first and last day.

    Hits are combined by (event, day). Visits carry their steps as bits of a long, so the
    shuffle by visit holds a key and a word whatever the number of steps.
    """
    hits = df.agg(F.count(F.lit(1))).scalar()
    ids = list(steps)
    flagged = df.select(visit.alias("visit"), event_presence(events).alias("ids")).where("visit is not null").select(
        "visit", *flag_words([F.array_contains("ids", i) for i in ids]))
    per_visit = flagged.groupBy("visit").agg(*or_words(len(ids)))
    counts = per_visit.agg(*[count_flag(i).alias(f"v{i}") for i in range(len(ids))])
    by_visit = counts.select(F.inline(F.array(*[
        F.struct(F.lit(e).alias("event_id"), F.col(f"v{i}").alias("visits")) for i, e in enumerate(ids)])))
    rows = _carrying(df, events, ids, F.to_date(as_col(day)).alias("date"))
    by_day = rows.groupBy("event_id", "date").agg(F.count(F.lit(1)).alias("n")).groupBy("event_id").agg(
        F.sum("n").alias("hits"), F.count("date").alias("active_days"),
        F.min("date").alias("first_seen"), F.max("date").alias("last_seen"))
    names = df.sparkSession.createDataFrame(list(steps.items()), "event_id string, name string")
    out = names.join(by_day, "event_id", "left").join(by_visit, "event_id", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "event_id", "name", F.coalesce("hits", zero).alias("hits"), F.coalesce("visits", zero).alias("visits"),
        F.round(F.try_divide(F.coalesce("hits", zero) * 100.0, hits), 4).alias("pct_of_hits"),
        F.coalesce("active_days", zero).alias("active_days"), "first_seen", "last_seen",
        (F.coalesce("hits", zero) > 0).alias("fires"))


def funnel_ratios(summary: DataFrame, ratios: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Population ratios on hit and visit basis; the funnel is not monotonic, so above 1 is
    legal, and an empty denominator counts as 1."""
    ids = sorted({i for _, n, d in ratios for i in (n, d)})
    wide = summary.agg(*[F.max(F.when(F.col("event_id") == i, F.col(b))).alias(f"{b}_{i}")
                         for i in ids for b in ("hits", "visits")])

    def ratio(b, n, d):
        return F.round(F.coalesce(F.col(f"{b}_{n}"), F.lit(0)) / F.greatest(F.coalesce(F.col(f"{b}_{d}"), F.lit(0)), F.lit(1)), 4)

    rows = F.array(*[F.struct(F.lit(name).alias("ratio"), ratio("hits", n, d).alias("hit_basis"),
                              ratio("visits", n, d).alias("visit_basis")) for name, n, d in ratios])
    return wide.select(F.inline(rows))


def funnel_by_language(df: DataFrame, events: str, ids: Sequence[str], language: Column) -> DataFrame:
    return (_carrying(df, events, ids, language.alias("language")).groupBy("language", "event_id")
            .agg(F.count(F.lit(1)).alias("hits")))
