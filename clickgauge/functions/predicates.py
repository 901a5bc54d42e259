"""Scope, eligibility and link-rule predicates.

Every predicate used for exclusion is NULL-safe (NULL input gives False), so that negating
it keeps the row instead of silently dropping it.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import any_of, as_col, bind, nonblank, pick_col
from .url import pct_decode4, strip_query, url_coalesce, url_coalesce_raw


def no_null(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def like_any(c: str | Column, patterns: Sequence[str]) -> Column:
    """OR of LIKE patterns; patterns are lower-cased, the column should already be."""
    return no_null(any_of(as_col(c).like(p.lower()) for p in patterns))


def _included(url: Column, include: Sequence[str], exclude: Sequence[str]) -> Column:
    return like_any(url, include) & ~like_any(url, exclude)


def scope_url(url: Column, include: Sequence[str], exclude: Sequence[str] = ()) -> Column:
    """Include AND NOT exclude; the url expression is evaluated once for all patterns."""
    return bind(url, lambda u: _included(u, include, exclude))


def scope_url_single_root(c: str | Column, pattern: str) -> Column:
    """One case-sensitive LIKE on one column (NULL gives NULL, hence no row)."""
    return as_col(c).like(pattern)


def scope_baseline_dated(url: Column, include: Sequence[str], exclude: Sequence[str],
                         retired: Sequence[str], until: date | str, day: str | Column) -> Column:
    """URL scope that also admits retired hosts, but only up to a date."""
    in_time = as_col(day) <= F.lit(str(until)).cast("date")
    return bind(url, lambda u: _baseline(u, include, exclude, retired, in_time))


def _baseline(url: Column, include, exclude, retired, in_time: Column) -> Column:
    return (like_any(url, include) | (like_any(url, retired) & in_time)) & ~like_any(url, exclude)


def scope_login_exclude(page_url: Column, hosts: Sequence[str]) -> Column:
    """True for rows to keep. Takes the page url only: link targets may name login hosts."""
    return bind(page_url, lambda u: ~like_any(u, hosts))


def scope_suite(suite: str | Column, suite_id: str, url_scope: Column,
                legacy: tuple[str, Column] | None = None) -> Column:
    """Suite id AND url scope, optionally OR a legacy suite with its own url scope."""
    cond = (as_col(suite) == suite_id) & url_scope
    if legacy:
        cond = cond | ((as_col(suite) == legacy[0]) & legacy[1])
    return cond


@dataclass(frozen=True)
class Scope:
    """Declared scope of a feed; :meth:`condition` turns it into one predicate."""

    url_cols: tuple[str, ...] = ("page_url", "post_page_url")
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    login_hosts: tuple[str, ...] = ()
    suite_col: str = "rsid"
    suites: tuple[str, ...] = ()
    retired: tuple[str, ...] = ()
    retired_until: str | None = None
    day_col: str = "hit_date"
    raw_coalesce: bool = False

    def condition(self, df: DataFrame) -> tuple[Column, dict[str, list[str]]]:
        """The predicate, and which declared parts the table can express."""
        active, missing, conds = [], [], []
        cols = [c for c in (pick_col(df, n) for n in self.url_cols) if c]
        suite = pick_col(df, self.suite_col)
        if self.suites:
            if suite:
                wanted = [s.strip().lower() for s in self.suites]
                conds.append(no_null(F.lower(F.trim(as_col(suite).cast("string"))).isin(wanted)))
            (active if suite else missing).append("suite")
        if self.include or self.exclude or self.login_hosts:
            if cols:
                url = (url_coalesce_raw if self.raw_coalesce else url_coalesce)(*cols)
                conds.append(bind(url, self._url_condition))
            (active if cols else missing).append("url")
        out = F.lit(True)
        for c in conds:
            out = out & c
        return out, {"active": active, "missing": missing}

    def _url_condition(self, url: Column) -> Column:
        cond = ~like_any(url, self.exclude) if self.exclude else F.lit(True)
        if self.include and self.retired and self.retired_until:
            in_time = as_col(self.day_col) <= F.lit(self.retired_until).cast("date")
            cond = _baseline(url, self.include, self.exclude, self.retired, in_time)
        elif self.include:
            cond = _included(url, self.include, self.exclude)
        return cond & ~like_any(url, self.login_hosts) if self.login_hosts else cond


# Hit sources that are uploads rather than visits.
UPLOAD_SOURCES = (5, 7, 8, 9)


def hit_eligible(exclude: str | Column = "exclude_hit", source: str | Column = "hit_source",
                 bad_sources: Sequence[int] = UPLOAD_SOURCES) -> Column:
    """Kept by the reporting rules; NULL or non-numeric codes keep the row."""
    kept = F.coalesce(as_col(exclude).try_cast("int"), F.lit(0)) == 0
    return kept & ~no_null(as_col(source).try_cast("int").isin(list(bad_sources)))


def geo_filter(country: str | Column, countries: Sequence[str] = (),
               region: str | Column | None = None, regions: Sequence[str] = ()) -> Column:
    cond = F.lit(True)
    if countries:
        cond = cond & F.upper(as_col(country)).isin([c.upper() for c in countries])
    if regions:
        cond = cond & F.upper(as_col(region)).isin([r.upper() for r in regions])
    return cond


def date_range_filter(day: str | Column, start: str, end: str) -> Column:
    return as_col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def brand_tag_match(c: str | Column, *parts: str) -> Column:
    """The tag contains every part, whatever the delimiter."""
    cond = F.lit(True)
    for p in parts:
        cond = cond & F.lower(as_col(c)).contains(p.lower())
    return no_null(cond)


def uncovered(hp: Column, category: str, noise: Sequence[str], include: Sequence[str]) -> Column:
    """Urls of a category that are neither noise nor in scope."""
    return bind(hp, lambda u: no_null(u.rlike(category)) & ~like_any(u, noise) & ~like_any(u, include))


MOBILE_SOURCE_PATTERN = "^(mobile|sdk|app_measurement)"


def mobile_hit(app_id: str | Column, source: str | Column) -> Column:
    return nonblank(app_id) | no_null(F.lower(as_col(source)).rlike(MOBILE_SOURCE_PATTERN))


@dataclass(frozen=True)
class LinkRule:
    """A qualifying link: tokens are matched on the decoded href, language on the raw one."""

    rule_id: str
    lang: str
    href: str
    token: str
    anti_token: str = ""
    lang_token: str = ""
    lang_anti_token: str = ""
    link_name: str = ""
    link_name_garbled: str = ""

    @property
    def key(self) -> str:
        return f"{self.rule_id}_{self.lang}"


def _rule_condition(rule: LinkRule, raw: Column, plain: Column) -> Column:
    cond = plain.contains(rule.token)
    if rule.anti_token:
        cond = cond & ~plain.contains(rule.anti_token)
    if rule.lang_token:
        cond = cond & raw.contains(rule.lang_token)
    if rule.lang_anti_token:
        cond = cond & ~raw.contains(rule.lang_anti_token)
    return cond


def rule_match(rule: LinkRule, href: str | Column) -> Column:
    raw = F.lower(as_col(href))
    return no_null(_rule_condition(rule, raw, pct_decode4(raw)))


def any_rule(rules: Sequence[LinkRule], href: str | Column) -> Column:
    """True where at least one rule matches.

    Made for filters, which do not share common sub-expressions: the lower-cased and the
    decoded href are bound once per row for all rules, and blank hrefs are not looked at.
    """
    raw = F.lower(as_col(href))
    matched = bind(raw, lambda r: bind(pct_decode4(r), lambda p: any_of(_rule_condition(x, r, p) for x in rules)))
    return F.when(nonblank(href), no_null(matched)).otherwise(False)


STRATEGIES = ("exact", "prefix", "path", "token", "token_name")


def rule_strategies(rule: LinkRule, href: str | Column, link_name: str | Column) -> dict[str, Column]:
    """The same rule under five matching strategies, to compare how they merge or split."""
    raw = F.lower(as_col(href))
    name = F.lower(F.trim(as_col(link_name)))
    wanted = [n.lower() for n in (rule.link_name, rule.link_name_garbled) if n]
    by_name = name.isin(wanted) if wanted else (name.isNull() | (name == ""))
    token = rule_match(rule, href)
    target = rule.href.lower()
    conds = {
        "exact": raw == target,
        "prefix": raw.startswith(target),
        "path": strip_query(raw) == target.split("?")[0].split("#")[0],
        "token": token,
        "token_name": token & no_null(by_name),
    }
    return {k: no_null(c) for k, c in conds.items()}


def channel_predicates(defs: dict[str, str]) -> dict[str, Column]:
    """Segment predicates held as SQL text in a registry, as NULL-safe flags."""
    return {name: no_null(F.expr(text)) for name, text in defs.items()}
