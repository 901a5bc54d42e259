"""Filters and predicates."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import url as U
from .base import on_hits
from .expressions import COALESCED, URL_COLS

URL = f"urls as (select *, {COALESCED} as url from hits)"
INCLUDE = ("%plans.example.com%", "%regimes.example.net%")
EXCLUDE = ("%uat.%",)
RETIRED = ("%old.example.org%",)
LOGIN = ("%login.example.com%", "%id.example.com%")
INC = "(url like '%plans.example.com%' or url like '%regimes.example.net%')"
EXC = "url like '%uat.%'"

RULES = (
    P.LinkRule("signin_member", "en", "https://id.example.com/signin?goto=%2fmember&ui_locales=EN", "goto=/member",
               lang_token="ui_locales=en", link_name="Sign in"),
    P.LinkRule("signin_member", "fr", "https://id.example.com/signin?goto=%2fmember&ui_locales=fr", "goto=/member",
               lang_token="ui_locales=fr", link_name="Régimes", link_name_garbled="RÃ©gimes"),
    P.LinkRule("signin_join", "en", "https://id.example.com/signin?goto=%2fjoin&ui_locales=EN", "goto=/join",
               lang_token="ui_locales=en", link_name="Sign in"),
    P.LinkRule("signin_join", "fr", "https://id.example.com/signin?goto=%2fjoin&ui_locales=fr", "goto=/join",
               lang_token="ui_locales=fr", link_name="Se connecter"),
    P.LinkRule("advisor", "any", "https://id.example.com/advisor", "/advisor", lang_anti_token="ui_locales=de"),
    P.LinkRule("app", "any", "https://id.example.com/store/app?id=5&ui_locales=fr", "/store/app", anti_token="hl=en"),
)
# The same rules spelled out over the raw lower-cased href `r` (NULL hrefs never match).
RULE_SQL = {
    "signin_member_en": "r like '%goto=\\%2fmember%' escape '\\' and r like '%ui\\_locales=en%' escape '\\'",
    "signin_member_fr": "r like '%goto=\\%2fmember%' escape '\\' and r like '%ui\\_locales=fr%' escape '\\'",
    "signin_join_en": "r like '%goto=\\%2fjoin%' escape '\\' and r like '%ui\\_locales=en%' escape '\\'",
    "signin_join_fr": "r like '%goto=\\%2fjoin%' escape '\\' and r like '%ui\\_locales=fr%' escape '\\'",
    "advisor_any": "r like '%/advisor%' and r not like '%ui\\_locales=de%' escape '\\'",
    "app_any": "r like '%/store/app%' and r not like '%hl=en%'",
}
RULE_SQL = {k: f"coalesce({v}, false)" for k, v in RULE_SQL.items()}
ANY_SQL = "(" + " or ".join(RULE_SQL.values()) + ")"
HREFS = "hrefs as (select *, lower(href) as r from hits)"


def url_of():
    return U.url_coalesce(*URL_COLS)


@on_hits("like_any", f"select hit_id, {INC} as m, not {INC} as kept from urls", URL)
def _(h):
    m = P.like_any(url_of(), INCLUDE)
    return h.select("hit_id", m.alias("m"), (~m).alias("kept"))


@on_hits("scope_url", f"select hit_id from urls where {INC} and not {EXC}", URL)
def _(h):
    return h.where(P.scope_url(url_of(), INCLUDE, EXCLUDE)).select("hit_id")


@on_hits("scope_url_single_root", "select hit_id from hits where page_url like 'https://www.plans.example.com/%'")
def _(h):
    return h.where(P.scope_url_single_root("page_url", "https://www.plans.example.com/%")).select("hit_id")


@on_hits("scope_baseline_dated", f"""select hit_id from urls where ({INC} or (url like '%old.example.org%'
    and hit_date <= date '2024-01-12')) and not {EXC}""", URL)
def _(h):
    return h.where(P.scope_baseline_dated(url_of(), INCLUDE, EXCLUDE, RETIRED, "2024-01-12", "hit_date")).select("hit_id")


@on_hits("scope_suite", f"""select hit_id, rsid from urls where (rsid = 'suite_a' and {INC} and not {EXC})
    or (rsid = 'suite_b' and url like '%old.example.org%')""", URL)
def _(h):
    cond = P.scope_suite("rsid", "suite_a", P.scope_url(url_of(), INCLUDE, EXCLUDE),
                         ("suite_b", P.like_any(url_of(), RETIRED)))
    return h.where(cond).select("hit_id", "rsid")


@on_hits("scope_login_exclude", "select hit_id from urls where url not like '%login.example.com%' and url not like '%id.example.com%'", URL)
def _(h):
    return h.where(P.scope_login_exclude(url_of(), LOGIN)).select("hit_id")


SCOPE = P.Scope(url_cols=URL_COLS, include=INCLUDE, exclude=EXCLUDE, login_hosts=LOGIN,
                suites=("SUITE_A ", "suite_b"))
SCOPE_SQL = f"lower(trim(rsid)) in ('suite_a', 'suite_b') and {INC} and not {EXC} and url not like '%login.example.com%' and url not like '%id.example.com%'"


@on_hits("scope_condition", f"select hit_id, 'suite,url' as active, '' as missing from urls where {SCOPE_SQL}", URL)
def _(h):
    cond, report = SCOPE.condition(h)
    return h.where(cond).select("hit_id", F.lit(",".join(report["active"])).alias("active"),
                                F.lit(",".join(report["missing"])).alias("missing"))


@on_hits("hit_eligible", """select hit_id from hits where coalesce(try_cast(exclude_hit as int), 0) = 0
    and coalesce(try_cast(hit_source as int), 0) not in (5, 7, 8, 9)""")
def _(h):
    return h.where(P.hit_eligible()).select("hit_id")


@on_hits("geo_filter", "select hit_id from hits where geo_country = 'can' and geo_region in ('on', 'qc')")
def _(h):
    return h.where(P.geo_filter("geo_country", ["CAN"], "geo_region", ["ON", "qc"])).select("hit_id")


@on_hits("date_range_filter", "select hit_id from hits where hit_date between date '2024-01-05' and date '2024-01-20'")
def _(h):
    return h.where(P.date_range_filter("hit_date", "2024-01-05", "2024-01-20")).select("hit_id")


@on_hits("rule_match", f"select hit_id, {', '.join(f'{s} as {k}' for k, s in RULE_SQL.items())} from hrefs", HREFS)
def _(h):
    return h.select("hit_id", *[P.rule_match(r, "href").alias(r.key) for r in RULES])


@on_hits("any_rule", f"select hit_id from hrefs where {ANY_SQL}", HREFS)
def _(h):
    return h.where(P.any_rule(RULES, "href")).select("hit_id")


@on_hits("rule_strategies", """select hit_id, coalesce(r = 'https://id.example.com/signin?goto=%2fmember&ui_locales=fr', false) as exact,
    coalesce(starts_with(r, 'https://id.example.com/signin?goto=%2fmember&ui_locales=fr'), false) as prefix,
    coalesce(r like 'https://id.example.com/signin?%', false) as path, """ + RULE_SQL["signin_member_fr"] + """ as token,
    """ + RULE_SQL["signin_member_fr"] + """ and coalesce(lower(trim(link_name)) in ('régimes', 'rã©gimes'), false) as token_name
    from hrefs""", HREFS)
def _(h):
    ways = P.rule_strategies(RULES[1], "href", "link_name")
    return h.select("hit_id", *[c.alias(n) for n, c in ways.items()])


@on_hits("brand_tag_match", "select hit_id, brand_tag like '%ca-plan%' and brand_tag like '%Core%' as m from hits")
def _(h):
    return h.select("hit_id", P.brand_tag_match("brand_tag", "ca-plan", "CORE").alias("m"))


@on_hits("uncovered", f"""select hit_id from urls where (url like '%.example.net%' or url like '%.example.org%')
    and not {EXC} and not {INC}""", URL)
def _(h):
    return h.where(P.uncovered(url_of(), r"\.example\.(net|org)", EXCLUDE, INCLUDE)).select("hit_id")


@on_hits("mobile_hit", "select hit_id from hits where coalesce(mobileappid, '') <> '' or hit_source like 'sdk%'")
def _(h):
    return h.where(P.mobile_hit("mobileappid", "hit_source")).select("hit_id")


CHANNELS = {"public": "rsid = 'suite_a' and brand_tag like 'ca-plan%'",
            "mobile": "trim(mobileappid) <> ''", "paid": "campaign = 'abc'"}


@on_hits("channel_predicates", "select hit_id, " + ", ".join(f"coalesce({v}, false) as {k}" for k, v in CHANNELS.items()) + " from hits")
def _(h):
    return h.select("hit_id", *[c.alias(n) for n, c in P.channel_predicates(CHANNELS).items()])
