"""Registry-driven KPI build.

Three aggregates over the hits, however many series there are, each reading its own columns only:

* hit grain: totals, page views, dimension shares and, on the hit basis, event occurrences. Counts of
  a hit's own columns are conditional sums; occurrences are tags of the hit, cut down to the tracked
  ids before they are exploded, and counted in the same pass. Map-side combine leaves a row per day
  (and tag) and task, so nothing hit-sized is shuffled;
* visit grain, ``groupBy(day, visit)`` then day: visits, page-view buckets and, on the visit
  basis, which events and cells the visit carried. Those flags travel as bits of a long,
  so the shuffle holds a key and a word per visit instead of a column per series;
* visitor grain, ``groupBy(day, visitor)`` then day.

Distinct counts are two-level group-bys, so a hot day or key is combined before it is shuffled and no
set of keys is held in one task. The results (one row per day) are merged by a union and one aggregate,
and days without hits are filled in from the gaps between its rows: the hits are not read for a calendar.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.events import list_ids
from ..functions.keys import count_flag, flag_words, or_words, page_view_flag, pv_bucket
from ..functions.text import count_where
from ..operators.calendar import fill_days, stack_days
from .registry import Cell, Event, PageBucket, Registry, Share, Total

DATE = "date"


def _claimed(dim: str, cells: list[Cell]) -> list[str]:
    return sorted({c.segment for c in cells if c.dim == dim and c.segment is not None})


def _in_cell(cell: Cell, cells: list[Cell]) -> Column:
    """Does the row's value fall in the cell? NULL, blank and unclaimed values are in the last one."""
    if cell.segment is not None:
        return F.coalesce(F.col(cell.dim) == cell.segment, F.lit(False))
    return ~F.coalesce(F.col(cell.dim).isin(_claimed(cell.dim, cells)), F.lit(False))


def _has_pages(reg: Registry) -> bool:
    return bool(reg.counted(PageBucket)) or any(t.of == "page_views" for t in reg.counted(Total))


def _hit_columns(df: DataFrame, reg: Registry) -> DataFrame:
    """Only what the series need."""
    dims = sorted({c.dim for c in reg.counted(Share, Cell)})
    cols = [F.to_date(reg.date_col).alias(DATE), reg.visit_expr().alias("_visit"),
            reg.visitor_expr().alias("_visitor"), *[F.col(d) for d in dims]]
    tracked = sorted({c.event for c in reg.counted(Event, Cell)})
    if tracked:
        cols.append(F.filter(list_ids(reg.event_col), lambda x: x.isin(tracked)).alias("_ids"))
    if _has_pages(reg):
        cols.append(page_view_flag(reg.page_view_basis, reg.page_marker).alias("_pv"))
    return df.select(*cols).where(F.col(DATE).isNotNull())


def _hit_grain(hits: DataFrame, reg: Registry) -> DataFrame:
    tracked = reg.counted(Event, Cell) if reg.event_basis == "hits" else []
    shares = reg.counted(Share)
    own = {"hits": F.lit(1), **({"page_views": F.col("_pv")} if _has_pages(reg) else {}),
           **{s.count_name: F.when(F.col(s.dim) == s.segment, 1).otherwise(0) for s in shares}}
    if not tracked:
        return hits.groupBy(DATE).agg(*[F.sum(c).alias(n) for n, c in own.items()])
    # The hit itself is the tag NULL; every occurrence of a tracked id is one more.
    cells = reg.counted(Cell)
    dims = sorted({c.dim for c in cells})
    buckets = [F.when(F.col(d).isin(_claimed(d, cells)), F.col(d)).alias(d) for d in dims]
    itself = F.array(F.lit(None).cast("string"))
    tagged = hits.select(DATE, *buckets, *[c.alias(f"_own_{i}") for i, c in enumerate(own.values())],
                         F.explode(F.concat(itself, F.coalesce("_ids", F.array().cast("array<string>")))).alias("_id"))
    sums = [F.sum(F.when(F.col("_id").isNull(), F.col(f"_own_{i}"))).alias(n) for i, n in enumerate(own)]
    per_id = tagged.groupBy(DATE, "_id", *dims).agg(F.count(F.lit(1)).alias("_n"), *sums)

    def occurrences(c) -> Column:
        cond = F.col("_id") == c.event
        if isinstance(c, Cell):
            cond = cond & (F.col(c.dim).isNull() if c.segment is None else F.col(c.dim) == c.segment)
        return F.sum(F.when(cond, F.col("_n"))).alias(c.count_name)

    return per_id.groupBy(DATE).agg(*[F.sum(f"`{n}`").alias(n) for n in own], *[occurrences(c) for c in tracked])


def _visit_grain(hits: DataFrame, reg: Registry) -> DataFrame:
    keep, per_visit, per_day = [], [], [F.count(F.lit(1)).alias("visits")]
    if reg.event_basis == "visits":
        tracked, cells = reg.counted(Event, Cell), reg.counted(Cell)
        carried = [F.array_contains("_ids", c.event) & (_in_cell(c, cells) if isinstance(c, Cell) else F.lit(True)) for c in tracked]
        keep += flag_words(carried)
        per_visit += or_words(len(tracked))
        per_day += [count_flag(i).alias(c.count_name) for i, c in enumerate(tracked)]
    buckets = reg.counted(PageBucket)
    if buckets:
        keep.append(F.col("_pv"))
        per_visit.append(F.sum("_pv").alias("_pvs"))
        per_day += [count_where(pv_bucket("_pvs") == b.bucket).alias(b.count_name) for b in buckets]
    keyed = hits.where(F.col("_visit").isNotNull()).select(DATE, "_visit", *keep).groupBy(DATE, "_visit")
    visits = keyed.agg(*per_visit) if per_visit else keyed.agg(F.lit(1).alias("_one"))
    return visits.groupBy(DATE).agg(*per_day)


def daily_distinct(hits: DataFrame, key: str | Column, out: str, day: str = DATE) -> DataFrame:
    """Distinct non-NULL keys per day as a two-level group-by."""
    key = F.col(key) if isinstance(key, str) else key
    keys = hits.select(day, key.alias("_key")).where(F.col("_key").isNotNull()).distinct()
    return keys.groupBy(day).agg(F.count(F.lit(1)).alias(out))


def kpi_expressions(reg: Registry) -> dict[str, Column]:
    """Metric expressions over the merged counts; ratios are resolved after their siblings."""
    out: dict[str, Column] = {}
    for s in sorted(reg.series, key=lambda s: not s.counts):
        out[s.metric_id] = s.value(out)
    return out


def kpi_wide(df: DataFrame, reg: Registry, first_day: str | None = None) -> DataFrame:
    """One row per calendar day, one column per series in registry order.

    The calendar runs from the first to the last day with hits, or from ``first_day`` if that is earlier."""
    exprs = kpi_expressions(reg)
    hits = _hit_columns(df, reg)
    parts = [_hit_grain(hits, reg), _visit_grain(hits, reg), daily_distinct(hits, "_visitor", "visitors")]
    counts = [c for p in parts for c in p.columns if c != DATE]
    merged = fill_days(stack_days(parts, counts, DATE), counts, DATE, first_day)
    return merged.select(DATE, *[exprs[m].alias(m) for m in reg.metric_ids]).orderBy(DATE)


def kpi_long(wide: DataFrame, date_col: str = DATE) -> DataFrame:
    """[date, metric_id, value double]."""
    metrics = [c for c in wide.columns if c != date_col]
    typed = wide.select(date_col, *[F.col(f"`{m}`").cast("double").alias(m) for m in metrics])
    return typed.unpivot([date_col], [f"`{m}`" for m in metrics], "metric_id", "value")


def kpi_pivot_back(long: DataFrame, metrics: list[str], date_col: str = DATE) -> DataFrame:
    return long.groupBy(date_col).agg(
        *[F.max(F.when(F.col("metric_id") == m, F.col("value"))).alias(m) for m in metrics])
