"""Quoting, blank tests, splitting and labelling."""
from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN_LABEL = "unknown"


def qcol(name: str) -> Column:
    """Reference a top-level column whose name may contain dots."""
    return F.col("`{}`".format(name.replace("`", "``")))


def as_col(c: str | Column) -> Column:
    return qcol(c) if isinstance(c, str) else c


def nonblank(c: str | Column) -> Column:
    """True where the value is present; feeds write '' as often as NULL. Never NULL."""
    c = as_col(c)
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def blank_to_null(c: str | Column) -> Column:
    c = F.trim(as_col(c).cast("string"))
    return F.when(c != "", c)


def flag(cond: Column) -> Column:
    """1 where ``cond`` holds, else 0 (NULL counts as 0)."""
    return F.when(cond, 1).otherwise(0)


def count_where(cond: Column) -> Column:
    """Rows where ``cond`` holds; 0, not NULL, on an empty group."""
    return F.count(F.when(cond, True))


def share_where(cond: Column) -> Column:
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def pct(num: Column, den: Column, digits: int = 3) -> Column:
    """Percentage with a zero denominator giving NULL instead of an ANSI error."""
    return F.round(F.try_divide(num * F.lit(100.0), den), digits)


def ratio0(num: Column, den: Column) -> Column:
    """num / den, 0.0 when the denominator is not positive. Not clamped: above 1 is legal."""
    return F.when(den > 0, F.try_divide(num.cast("double"), den.cast("double"))).otherwise(F.lit(0.0))


def pick_col(df: DataFrame, *names: str) -> str | None:
    """First of ``names`` that the table has, ignoring case."""
    have = {c.lower(): c for c in df.columns}
    return next((have[n.lower()] for n in names if n.lower() in have), None)


def evar(df: DataFrame, n: int) -> str | None:
    """Custom variable ``n``, preferring the processed (post_) column."""
    return pick_col(df, f"post_evar{n}", f"evar{n}")


def any_of(conds) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def bind(value: Column, body) -> Column:
    """``body`` over ``value``, evaluating ``value`` once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_literal(c: str | Column, delim: str) -> Column:
    return F.split(as_col(c), re.escape(delim))


def split_part(c: str | Column, delim: str, i: int) -> Column:
    """1-based part of a literally delimited string; NULL past the end."""
    return F.try_element_at(split_literal(c, delim), F.lit(i))


def brand_triple(c: str | Column, delim: str) -> Column:
    names = ("brand", "lob", "segment")
    return F.struct(*[F.trim(split_part(c, delim, i)).alias(n) for i, n in enumerate(names, 1)])


def slug(c: str | Column) -> Column:
    """Lower-case, runs of non-alphanumerics to one '-', no leading or trailing '-'."""
    dashed = F.regexp_replace(F.lower(as_col(c)), r"[^\p{L}\p{N}]+", "-")
    return F.regexp_replace(dashed, "^-+|-+$", "")


def slug_text(value: str) -> str:
    """Driver-side form of :func:`slug`, for naming metrics from registry values."""
    return "-".join(re.findall(r"[^\W_]+", value.lower()))


def code_label(c: str | Column, labels: dict[str, str], other: str = "Other") -> Column:
    c = as_col(c).cast("string")
    out = F.lit(other)
    for code, label in labels.items():
        out = F.when(c == code, label).otherwise(out)
    return out


# Severity tiers on the absolute robust z.
SEVERITY_TIERS = {"critical": 12.0, "major": 8.0, "minor": 5.0}


def severity(z: Column, tiers: dict[str, float] = SEVERITY_TIERS) -> Column:
    out = F.lit("warn")
    for name, floor in sorted(tiers.items(), key=lambda kv: kv[1]):
        out = F.when(z >= floor, name).otherwise(out)
    return out


def anomaly_id(metric: Column, day: Column, detector: Column) -> Column:
    return F.concat_ws(":", metric, day.cast("string"), detector)


def log_transform(value: Column, is_count: Column) -> Column:
    """Counts are compared on a log scale, everything else as it is."""
    return F.when(is_count, F.log1p(value)).otherwise(value)


def log_inverse(value: Column, is_count: Column) -> Column:
    return F.when(is_count, F.expm1(value)).otherwise(value)


def iso3_upper(c: str | Column) -> Column:
    return F.upper(F.trim(as_col(c)))
