"""URL parts, tags and language derivations, all as regular-expression built-ins."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, blank_to_null, nonblank

BLANK = "<blank>"
UNKNOWN = "unknown"

# Host classes, tested in this order.
HOST_ENV_PATTERNS = {
    "aem_authoring": r"adobeaemcloud\.com|author-|-author\.",
    "uat": r"(^|\.)uat[.\-]|(-|^)uat($|\.)",
    "stage": r"stage|staging|preview|dev\-|^dev\.",
    "other": r"localhost|\.local$|\.test$",
}
# Coarse host classes.
NONPROD_PATTERN = r"preview|stage|staging|author|(^|\.)uat($|\.)|\.uat\.|(^|\.)dev\."
AEM_TOKENS = ("adobeaemcloud.com", "author-aem")
# A path segment that is an identifier.
ID_SEGMENT = (
    r"^([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
    r"|[0-9a-f]{16,}|[0-9]{4,})$"
)
# The only percent sequences decoded before link matching.
PERCENT_CODES = {"%3a": ":", "%2f": "/", "%3f": "?", "%3d": "="}


def url_coalesce(*cols: str | Column) -> Column:
    """First non-blank candidate, trimmed and lower-cased; '' when all are blank."""
    return F.lower(F.coalesce(*[blank_to_null(c) for c in cols], F.lit("")))


def url_coalesce_raw(*cols: str | Column) -> Column:
    """First non-NULL candidate: a blank stops the search and all-NULL stays NULL."""
    return F.lower(F.coalesce(*[as_col(c).cast("string") for c in cols]))


def strip_query(u: str | Column) -> Column:
    return F.regexp_extract(as_col(u), "^([^?#]*)", 1)


def drop_scheme(u: str | Column) -> Column:
    return F.regexp_replace(as_col(u), "^[a-z]+://", "")


def url_strip(u: str | Column) -> Column:
    """host/path: no scheme, leading www., query, fragment or trailing slashes."""
    bare = F.regexp_replace(drop_scheme(F.lower(F.trim(as_col(u)))), r"^www\.", "")
    return F.regexp_replace(strip_query(bare), "/+$", "")


def host_path(u: str | Column) -> Column:
    """host/path keeping www. and trailing slashes (scheme, query, fragment dropped)."""
    return strip_query(drop_scheme(F.lower(as_col(u))))


def url_host(hp: str | Column) -> Column:
    return F.regexp_extract(as_col(hp), "^([^/?#]+)", 1)


def url_path(hp: str | Column) -> Column:
    hp = as_col(hp)
    return F.when(hp.rlike("^[^/]+/"), F.regexp_extract(hp, "^[^/]+(/.*)$", 1)).otherwise(F.lit("/"))


def host_bucket(hp: Column) -> Column:
    return F.when(nonblank(hp), url_host(hp)).otherwise(F.lit(BLANK))


def path_bucket(hp: Column) -> Column:
    return F.when(nonblank(hp), url_path(hp)).otherwise(F.lit(BLANK))


def path_generalize_ids(path: str | Column) -> Column:
    """Replace identifier segments by {id}; works per segment, so no lookahead is needed."""
    parts = F.transform(
        F.split(as_col(path), "/"),
        lambda s, i: F.when((i > 0) & s.rlike(ID_SEGMENT), F.lit("{id}")).otherwise(s),
    )
    return F.array_join(parts, "/")


def path_prefix(path: str | Column, depth: int = 5) -> Column:
    """First ``depth`` segments of a '/'-rooted path, empty segments skipped after the first."""
    segs = F.slice(F.split(as_col(path), "/"), 2, depth)
    tail = F.filter(F.slice(segs, 2, depth), lambda s: s != "")
    return F.concat(
        F.lit("/"), F.coalesce(F.get(segs, F.lit(0)), F.lit("")),
        F.array_join(F.transform(tail, lambda s: F.concat(F.lit("/"), s)), ""),
    )


def first_matching(c: Column, patterns: dict[str, str], default: str | None) -> Column:
    """Name of the first pattern that matches, in dict order."""
    out = F.lit(default)
    for name, pattern in reversed(list(patterns.items())):
        out = F.when(c.rlike(pattern), name).otherwise(out)
    return out


def host_env_tag(host: str | Column) -> Column:
    return first_matching(as_col(host), HOST_ENV_PATTERNS, "prod")


def env_tag_coarse(host: str | Column) -> Column:
    host = as_col(host)
    aem = host.contains(AEM_TOKENS[0]) | host.contains(AEM_TOKENS[1])
    return F.when(aem, "aem").when(host.rlike(NONPROD_PATTERN), "nonprod").otherwise("prod")


def lang_from_host(url: str | Column, patterns: dict[str, str]) -> Column:
    """Language by host pattern (first match wins), 'unknown' otherwise."""
    return first_matching(url_host(drop_scheme(url)), patterns, UNKNOWN)


def lang_path_then_host(path: str | Column, host: str | Column,
                        path_patterns: dict[str, str], host_patterns: dict[str, str]) -> Column:
    return F.coalesce(first_matching(as_col(path), path_patterns, None),
                      first_matching(as_col(host), host_patterns, None), F.lit(UNKNOWN))


def lang_from_value(c: str | Column) -> Column:
    """en / fr when a tagged value starts so, else NULL."""
    v = F.lower(F.trim(as_col(c)))
    return F.when(v.startswith("fr"), "fr").when(v.startswith("en"), "en")


def lang_four_ways(href: str | Column, link_name: str | Column, page_url: str | Column, *,
                   href_hosts: dict[str, str], names: dict[str, list[str]],
                   page_patterns: dict[str, str]) -> dict[str, Column]:
    """Four independent language derivations of one link click.

    The parameter and host are read from the *raw* href: decoding first would surface
    nested locale parameters of redirect targets.
    """
    raw = F.lower(as_col(href))
    param = F.regexp_extract(raw, "[?&](?:ui_locales|hl|l)=([a-z]{2})", 1)
    name = F.lower(F.trim(as_col(link_name)))
    by_name = F.lit(UNKNOWN)
    for lang, wanted in names.items():
        by_name = F.when(name.isin([w.lower() for w in wanted]), lang).otherwise(by_name)
    return {
        "href_param": F.when(param.isin("en", "fr"), param).otherwise(UNKNOWN),
        "href_host": first_matching(raw, href_hosts, UNKNOWN),
        "link_name": by_name,
        "page_url": first_matching(F.lower(as_col(page_url)), page_patterns, UNKNOWN),
    }


def query_param(url: str | Column, key: str) -> Column:
    """Value of one query parameter, '' when absent."""
    return F.regexp_extract(F.coalesce(as_col(url), F.lit("")), f"[?&]{key}=([^&#]*)", 1)


def pct_decode4(u: str | Column) -> Column:
    out = as_col(u)
    for code, char in PERCENT_CODES.items():
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def href_elide(u: str | Column) -> Column:
    """Keep scheme, host, path and parameter names; hide every parameter value."""
    u = as_col(u)
    cut = F.instr(u, "?")
    head, tail = F.substring_index(u, "?", 1), u.substr(cut, F.length(u))
    return F.when(cut > 0, F.concat(head, F.regexp_replace(tail, "=[^&]*", "=<v>"))).otherwise(u)
