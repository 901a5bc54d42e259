"""KPI registries: which daily series exist and what each is made of.

A series is one of a few small types. Each names the daily counts it needs and the expression that
makes its value of them; :mod:`clickgauge.plans.builder` collects the counts of a whole registry into
one plan. A registry is configuration and never touches data. Who looks after a series is kept apart
from what it measures, in the registry's ``governance``.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import PV_BUCKETS, key_null_safe, key_plain
from ..functions.text import ratio0, slug_text

EVENT_BASES = ("hits", "visits")
VOLUMES = ("hits", "visits", "visitors")
OTHER = "evar4_other"  # fixed value: suffix of the cell for unclaimed values


@dataclass(frozen=True)
class Total:
    """All hits, visits, visitors or page views of a day."""

    metric_id: str
    of: str
    scored: bool = True
    kind, segment = "count", None

    def __post_init__(self):
        if self.of not in (*VOLUMES, "page_views"):
            raise ValueError(f"no such total: {self.of}")

    @property
    def counts(self) -> tuple:
        return (self,)

    @property
    def count_name(self) -> str:
        return self.of

    def value(self, _siblings) -> Column:
        return F.col(self.of)


@dataclass(frozen=True)
class Event:
    """Occurrences of an event, or visits that carried it, by the registry's basis."""

    metric_id: str
    event: str
    scored: bool = True
    kind, segment = "count", None

    @property
    def counts(self) -> tuple:
        return (self,)

    @property
    def count_name(self) -> str:
        return f"event_{self.event}"

    def value(self, _siblings) -> Column:
        return F.col(f"`{self.count_name}`")


@dataclass(frozen=True)
class EventRate:
    """Occurrences of an event per hit."""

    metric_id: str
    event: str
    scored: bool = True
    kind, segment = "rate", None

    @property
    def counts(self) -> tuple:
        return (Event(self.metric_id, self.event),)

    def value(self, _siblings) -> Column:
        return ratio0(self.counts[0].value(_siblings), F.col("hits"))


@dataclass(frozen=True)
class Share:
    """Share of the day's hits whose ``dim`` equals ``segment``."""

    metric_id: str
    dim: str
    segment: str
    scored: bool = True
    kind = "share"

    @property
    def counts(self) -> tuple:
        return (self,)

    @property
    def count_name(self) -> str:
        return f"share_{self.metric_id}"

    def value(self, _siblings) -> Column:
        return ratio0(F.col(f"`{self.count_name}`"), F.col("hits"))


@dataclass(frozen=True)
class Cell:
    """An event within one value of a dimension; ``segment=None`` holds every value no sibling claims."""

    metric_id: str
    event: str
    dim: str
    segment: str | None
    scored: bool = True
    kind = "count"

    @property
    def counts(self) -> tuple:
        return (self,)

    @property
    def count_name(self) -> str:
        return f"cell_{self.metric_id}"

    def value(self, _siblings) -> Column:
        return F.col(f"`{self.count_name}`")


@dataclass(frozen=True)
class PageBucket:
    """Share of the day's visits with so many page views."""

    metric_id: str
    bucket: str
    scored: bool = False
    kind, segment = "point_mass", None

    @property
    def counts(self) -> tuple:
        return (self,)

    @property
    def count_name(self) -> str:
        return f"bucket_{self.metric_id}"

    def value(self, _siblings) -> Column:
        return ratio0(F.col(f"`{self.count_name}`"), F.col("visits"))


@dataclass(frozen=True)
class Ratio:
    """One series over another."""

    metric_id: str
    over: str
    under: str
    scored: bool = True
    kind, segment = "ratio", None

    @property
    def counts(self) -> tuple:
        return ()

    def value(self, siblings: Mapping[str, Column]) -> Column:
        unknown = [m for m in (self.over, self.under) if m not in siblings]
        if unknown:
            raise ValueError(f"ratio {self.metric_id} refers to unknown series {unknown}")
        return ratio0(siblings[self.over], siblings[self.under])


Series = Total | Event | EventRate | Share | Cell | PageBucket | Ratio


@dataclass(frozen=True)
class Governance:
    status: str = "candidate"
    direction: str = "context_dependent"
    owner: str = "unassigned"


@dataclass(frozen=True)
class Registry:
    name: str
    series: tuple[Series, ...]
    date_col: str = "hit_date"
    visit_key: tuple[str, ...] = ("post_visid_high", "post_visid_low", "visit_num")
    visitor_key: tuple[str, ...] = ("mcvisid",)
    null_safe_keys: bool = False
    event_basis: str = "hits"
    page_view_basis: str = "all_hits"
    event_col: str = "post_event_list"
    page_marker: str = "post_page_event"
    rule_dims: tuple[str, ...] = ()
    governance: Mapping[str, Governance] = field(default_factory=dict)

    def __post_init__(self):
        if self.event_basis not in EVENT_BASES:
            raise ValueError(f"unknown event basis: {self.event_basis!r}")

    def of(self, *kinds: type) -> list[Series]:
        return [s for s in self.series if isinstance(s, kinds)]

    def counted(self, *kinds: type) -> list[Series]:
        """Each daily count of these types that some series needs, once."""
        return list({c.count_name: c for s in self.series for c in s.counts if isinstance(c, kinds)}.values())

    @property
    def metric_ids(self) -> list[str]:
        return [s.metric_id for s in self.series]

    @property
    def event_ids(self) -> list[str]:
        return list(dict.fromkeys(s.event for s in self.of(Event, EventRate)))

    @property
    def scored(self) -> list[Series]:
        """Series the detectors read; the others are built but raise no alerts."""
        return [s for s in self.series if s.scored]

    @property
    def count_metrics(self) -> list[str]:
        """Series on a count scale; detectors take their logarithm."""
        return [s.metric_id for s in self.series if s.kind == "count"]

    @property
    def volume_metrics(self) -> list[str]:
        return [s.metric_id for s in self.of(Total) if s.of in VOLUMES]

    def visit_expr(self) -> Column:
        return (key_null_safe if self.null_safe_keys else key_plain)(*self.visit_key)

    def visitor_expr(self) -> Column:
        """A single visitor column is counted as it is, so its NULLs are never visitors."""
        if len(self.visitor_key) == 1:
            return F.col(self.visitor_key[0]).cast("string")
        return (key_null_safe if self.null_safe_keys else key_plain)(*self.visitor_key)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The registry as a table, one row per series."""
        rows = []
        for s in self.series:
            g = self.governance.get(s.metric_id, Governance())
            rows.append((s.metric_id, type(s).__name__, s.kind, s.segment, g.status, g.direction, g.owner, s.kind == "count"))
        return spark.createDataFrame(rows, "metric_id string, type string, kind string, segment string, status string, "
                                           "direction string, owner string, log_scale boolean")


TOTALS = tuple(Total(f"{v}_total", v) for v in VOLUMES)


def shares(prefix: str, dim: str, values: Sequence[str]) -> list[Share]:
    return [Share(f"{prefix}_share_{slug_text(v)}", dim, v) for v in values]


def page_views() -> list[Series]:
    return [Total("page_views_total", "page_views", scored=False),
            Ratio("pv_per_visit", "page_views_total", "visits_total", scored=False),
            *[PageBucket(f"pv_bucket_share_{suffix}", b) for b, suffix in PV_BUCKETS.items()]]


def hit_basis_registry(name: str, event_ids: Sequence[str], rate_ids: Sequence[str],
                       pagenames: Sequence[str], languages: Sequence[str], **options) -> Registry:
    """Totals, event occurrences, event rates, dimension shares and the page-view family."""
    series = (*TOTALS, *[Event(f"event_{e}_count", e) for e in event_ids], *[EventRate(f"event_{e}_rate", e) for e in rate_ids],
              *shares("pagename", "post_pagename", pagenames), *shares("language", "language", languages), *page_views())
    return Registry(name, series, **options)


def visit_basis_registry(name: str, events: Mapping[str, str], ratios: Sequence[tuple[str, str, str]],
                         languages: Sequence[str], cube_events: Sequence[str], cube_dim: str,
                         cube_values: Mapping[str, str], owners: Mapping[str, Governance] | None = None,
                         **options) -> Registry:
    """Totals, visit-distinct events, funnel ratios, language shares, event x dimension cells.

    ``events`` maps an id to its metric, ``ratios`` are (metric, upper id, lower id), ``cube_values``
    maps a dimension value to its suffix, ``owners`` an event id to the governance of all made of it.
    """
    cells = {e: [Cell(f"{events[e]}__{suffix}", e, cube_dim, value) for value, suffix in [*cube_values.items(), (None, OTHER)]]
             for e in cube_events}
    series = (*TOTALS, *[Event(m, e) for e, m in events.items()], *[Ratio(m, events[n], events[d]) for m, n, d in ratios],
              *shares("language", "language", languages), *[c for row in cells.values() for c in row])
    governance = {}
    for e, g in (owners or {}).items():
        governance |= {m: g for m in [events[e], *[c.metric_id for c in cells.get(e, ())], *[m for m, n, _ in ratios if n == e]]}
    visit_basis = dict(visit_key=("post_visid_high", "post_visid_low", "visit_num", "visit_start_time_gmt"),
                       visitor_key=("post_visid_high", "post_visid_low"),
                       null_safe_keys=True, event_basis="visits", governance=governance)
    return Registry(name, series, **{**visit_basis, **options})


# Event ids tracked by the hit-basis feed.
HIT_BASIS_EVENT_IDS = (
    "20", "500", "501", "502", "503", "504",
    "10000", "10001", "10002", "10003", "10004", "10005", "10006", "10007", "10008",
    "10020", "10030", "10036", "10037", "10039", "10043", "10044", "10099",
)
HIT_BASIS_RATE_IDS = ("10036",)
HIT_BASIS_LANGUAGES = ("45", "39", "38")
HIT_BASIS_RULE_DIMS = ("post_pagename", "language", "ref_type", "connection_type", "browser",
                       "va_closer_id")
# Events of the visit-basis feed, the funnel in logical order last.
VISIT_BASIS_EVENTS = {
    "103": "pel_103_product_category_inst",
    "104": "pel_104_product_id_inst",
    "105": "pel_105_sponsor_distributor_inst",
    "110": "pel_110_quote_session_inst",
    "115": "pel_115_transaction_inst",
    "151": "pel_151_current_page_inst",
    "10047": "pel_10047_bot_detector_inst",
    "228": "pel_228_quote_start",
    "229": "pel_229_quote_complete",
    "232": "pel_232_save_quote",
    "269": "pel_269_app_start",
    "240": "pel_240_app_confirm",
}
FUNNEL_EVENTS = ("228", "229", "232", "269", "240")
FUNNEL_RATIOS = (
    ("funnel_quote_complete_over_quote_start", "229", "228"),
    ("funnel_save_quote_over_quote_start", "232", "228"),
    ("funnel_app_start_over_quote_start", "269", "228"),
    ("funnel_app_confirm_over_app_start", "240", "269"),
    ("funnel_app_confirm_over_quote_start", "240", "228"),
)
VISIT_BASIS_LANGUAGES = ("en", "fr", "unknown")


@dataclass(frozen=True)
class Thresholds:
    """Detector settings."""

    z_flag: float = 3.5
    high_quantile: float = 0.99
    quantile_z_floor: float = 3.0
    start_frac: float = 0.20
    min_history: int = 21
    dow_window: int = 4
    dow_min_history: int = 2
    ls_post_window: int = 7
    ls_pre_window: int = 21
    ls_z: float = 4.0
    min_active_frac: float = 0.90
    blank_jump_pp: float = 10.0
    blank_warmup: int = 14
    new_value_share: float = 0.01
    trailing_days: int = 28
    severity: dict = field(default_factory=lambda: {"critical": 12.0, "major": 8.0, "minor": 5.0})
