"""URL, suite, link and population profiling."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import predicates as P
from ..functions import text as T
from ..functions import url as U
from ..operators import links as L
from ..operators import populations as O
from ..operators import suites as S
from ..operators import urlprofile as UP
from ..operators.joins import flag_qualified
from .base import on_hits, on_pages
from .expressions import FOUR, FOUR_SQL, HOST_LANGS, HOST_LANG_SQL, PARTS, PATHS, PATH_LANGS, URL_COLS
from .filters import ANY_SQL, EXC, EXCLUDE, HREFS, INC, INCLUDE, LOGIN, RULES, RULE_SQL, URL, url_of
from .kpis import VK
from .profiling import N, PAIR, pair
from .quality import visit
from .series import rounded

HP_OF = "regexp_extract(regexp_replace(lower({c}), '^[a-z]+://', ''), '^([^?#]*)', 1)".format
UHP = f"uhp as (select *, {HP_OF(c='url')} as hp from urls)"


@on_hits("url_column_stats", "select *, cast(row_number() over (order by blank_pct, column_name) as int) as coalesce_rank from (" + " union all ".join(
    f"select '{c}' as column_name, count(*) as rows, count(nullif(trim({c}), '')) as nonblank, count(distinct {HP_OF(c=c)}) as distinct_urls, {N(f'{HP_OF(c=c)} = hp')} as matches_coalesce, "
    f"round(100.0 * (count(*) - count(nullif(trim({c}), ''))) / count(*), 3) as blank_pct from uhp" for c in URL_COLS) + ")", URL, UHP)
def _(h):
    return UP.url_column_stats(h, URL_COLS, exact=True)


@on_hits("url_column_agreement", f"""select {N('a and b')} as both, {N('a and not b')} as only_a, {N('b and not a')} as only_b, {N('not a and not b')} as neither from
    (select coalesce(lower(page_url) like '%plans.example.com%', false) as a, coalesce(lower(post_page_url) like '%plans.example.com%', false) as b from hits)""")
def _(h):
    return UP.url_column_agreement(h, *[P.like_any(F.lower(c), ["%plans.example.com%"]) for c in ("page_url", "post_page_url")])


TAGGED = (URL, UHP, f"""tagged as (select *, related and not sc and not noise as addable from (select hp, array_to_string(string_split(hp, '/')[1:5], '/') as section,
    case when hp like '%/fr/%' then 'fr' when hp like '%/en/%' then 'en' else 'other' end as lang, {INC} as sc, hp like '%/view/%' or hp like '%/signup/%' as related,
    hp like 'uat.%' as noise, hp not like '%.com/%' as alt_domain from uhp where hp <> ''))""")


def _tagged(h):
    hp = U.host_path(url_of())
    lang = U.first_matching(hp, {"fr": "/fr/", "en": "/en/"}, "other")
    return UP.url_scope_tags(h, hp, P.like_any(url_of(), INCLUDE), hp.rlike("/(view|signup)/"), hp.startswith("uat."), lang, ~hp.rlike(r"\.com/"))


@on_hits("url_scope_breakdown", f"""select count(*) as nonblank, {N('sc')} as in_scope, {N('related')} as related, {N('related and not noise')} as related_clean, {N('addable')} as addable,
    {N('addable and lang = $$fr$$')} as addable_fr, {N('addable and alt_domain')} as addable_alt_domain, {N('related and noise')} as related_noise from tagged""", *TAGGED)
def _(h):
    return UP.url_scope_breakdown(_tagged(h))


@on_hits("top_addable", "select rtrim(section, '/') as section, lang, alt_domain, count(*) as n from tagged where addable group by 1, 2, 3 order by n desc, 1, 2 limit 25", *TAGGED)
def _(h):
    return UP.top_addable(_tagged(h))


@on_hits("url_column_category", " union all ".join(
    f"select '{c}' as column_name, count(*) as rows, {N(f'{HP_OF(c=c)} like $$%/view/%$$')} as strict, {N(f'regexp_matches({HP_OF(c=c)}, $$view|click$$)')} as broad, "
    f"{N(f'{HP_OF(c=c)} like $$%/view/%$$ and not hp like $$%/view/%$$')} as beyond_coalesce from uhp" for c in URL_COLS), URL, UHP)
def _(h):
    return UP.url_column_category(h, URL_COLS, "/view/", "view|click")


@on_hits("pagename_sweep", f"""select count(*) as rows, count(nullif(trim(post_pagename), '')) as nonblank, count(distinct lower(post_pagename)) as distinct_names, {N('post_pagename like $$%:view:%$$')} as strict,
    {N('regexp_matches(post_pagename, $$view|click$$)')} as broad, round(100.0 * (count(*) - count(nullif(trim(post_pagename), ''))) / count(*), 3) as blank_pct from hits""")
def _(h):
    return UP.pagename_sweep(h, "post_pagename", ":view:", "view|click", exact=True)


@on_hits("suite_sweep", "select rsid, count(*) as hits, round(100.0 * count(*) / sum(count(*)) over (), 3) as pct_of_category from hits where post_pagename like '%view%' group by 1")
def _(h):
    return UP.suite_sweep(h, "rsid", F.col("post_pagename").contains("view"))


NEEDLES = ["plans.example.com", "regimes.example.net", "absent.example"]


@on_hits("host_presence", "select n.needle, count(u.hit_id) as hits, count(distinct u.hit_date) as active_days, min(u.hit_date) as first_day, max(u.hit_date) as last_day from (select unnest(['plans.example.com', 'regimes.example.net', 'absent.example']) as needle) n left join uhp u on u.hp <> '' and contains(string_split(u.hp, '/')[1], n.needle) group by 1", URL, UHP)
def _(h):
    return UP.host_presence(h, U.url_host(U.host_path(url_of())), "hit_date", NEEDLES)


@on_hits("host_presence_monthly", "select strftime(hit_date, '%Y-%m') as month, count(*) as hits from uhp where hp <> '' group by 1", URL, UHP)
def _(h):
    return UP.host_presence_monthly(h, U.url_host(U.host_path(url_of())), "hit_date")


ENV = ("case when regexp_matches({h}, 'adobeaemcloud\\.com|author-|author\\.') then 'aem_authoring' when regexp_matches({h}, '(^|\\.)uat[.\\-]|(-|^)uat($|\\.)') then 'uat' "
       "when regexp_matches({h}, 'stage|staging|preview|dev-|^dev\\.') then 'stage' when regexp_matches({h}, 'localhost|\\.local$|\\.test$') then 'other' else 'prod' end")
HOSTS = (URL, UHP, f"hosts as (select host, n, round(100.0 * n / tot, 3) as pct, round(100.0 * sum(n) over (order by n desc, host rows unbounded preceding) / tot, 3) as cumulative_pct, {ENV.format(h='host')} as env from "
         "(select string_split(hp, '/')[1] as host, count(*) as n, sum(count(*)) over () as tot from uhp where hp <> '' group by 1 order by n desc, host limit 50))")


def _hosts(h, k=50):
    return UP.top_hosts(h, U.url_host(U.host_path(url_of())), k)


def _all_hosts(h):
    return UP.host_shares(h, U.url_host(U.host_path(url_of())))


@on_hits("top_hosts", "select * from hosts", *HOSTS)
def _(h):
    return _hosts(h)


GEN1 = "array_to_string(list_transform(string_split(path, '/'), lambda s: case when regexp_full_match(s, '[0-9]{4,}|[0-9a-f]{16,}') then '{id}' else s end)[1:4], '/')"


@on_pages("top_path_prefixes", f"""select host, path_prefix, lang, n, round(100.0 * n / tot, 3) as pct, round(100.0 * sum(n) over (order by n desc, host, path_prefix, lang rows unbounded preceding) / tot, 3) as cumulative_pct, {ENV.format(h='host')} as env from
    (select host, path_prefix, lang, count(*) as n, sum(count(*)) over () as tot from (select host, rtrim({GEN1}, '/') as path_prefix,
     case when list_contains(string_split(path, '/'), 'fr') then 'fr' when list_contains(string_split(path, '/'), 'en') then 'en' else 'unknown' end as lang from paths) group by 1, 2, 3 order by n desc, 1, 2, 3 limit 30)""", PARTS, PATHS)
def _(p):
    hp = U.host_path("url")
    return UP.top_path_prefixes(p, hp, U.lang_path_then_host(U.url_path(hp), U.url_host(hp), PATH_LANGS, {}), 30, 3)


TAGS = ("lang", "env", "in_broad", "is_noise", "category")


def _tags():
    return {"lang": U.first_matching(F.col("path"), PATH_LANGS, "unknown"), "env": U.env_tag_coarse("host"),
            "in_broad": P.like_any("hp", INCLUDE), "is_noise": P.like_any("hp", EXCLUDE),
            "category": F.col("hp").rlike("/(view|signup)/")}


STRIP = "rtrim(regexp_extract(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '^www[.]', ''), '^([^?#]*)', 1), '/')"
INV = (URL, f"inv0 as (select *, {STRIP} as shp from urls)",
       "inv1 as (select *, case when shp = '' then '<blank>' else string_split(shp, '/')[1] end as host, case when shp = '' then '<blank>' when strpos(shp, '/') > 0 then substr(shp, strpos(shp, '/')) else '/' end as path from inv0)",
       "inv2 as (select *, case when path = '<blank>' then '/' else array_to_string(list_transform(string_split(path, '/'), lambda s: case when regexp_full_match(s, '[0-9]{4,}|[0-9a-f]{16,}') then '{id}' else s end)[1:6], '/') end as path_prefix, "
       "case when list_contains(string_split(path, '/'), 'fr') then 'fr' when list_contains(string_split(path, '/'), 'en') then 'en' else 'unknown' end as lang, "
       "case when host like 'uat.%' then 'nonprod' else 'prod' end as env, shp like '%plans.example.com%' or shp like '%regimes.example.net%' as in_broad, shp like '%uat.%' as is_noise, "
       "shp like '%/view/%' or shp like '%/signup/%' as category from inv1)",
       "inv as (select host, path, path_prefix, lang, env, in_broad, is_noise, category, count(*) as hits, count(distinct hit_date) as active_days, min(hit_date) as first_seen, max(hit_date) as last_seen, "
       + ", ".join(f"count(nullif(trim({c}), '')) as src_{c}_nb" for c in URL_COLS) + " from inv2 group by all)")


def _inventory(h, **kw):
    return UP.url_inventory(h, URL_COLS, "hit_date", _tags(), **kw)


@on_hits("url_inventory", "select * from inv where hits >= 2", *INV)
def _(h):
    return _inventory(h, min_hits=2)


@on_hits("url_rollup", """select host, path_prefix, lang, env, in_broad, is_noise, category, sum(hits)::bigint as hits, count(distinct path) as distinct_paths, min(first_seen) as first_seen,
    max(last_seen) as last_seen from inv group by all""", *INV)
def _(h):
    return UP.url_rollup(_inventory(h), list(TAGS))


@on_hits("inventory_summary", "select sum(hits)::bigint as hits, count(*) as inventory_rows, count(distinct host) as hosts, min(first_seen) as first_seen, max(last_seen) as last_seen, coalesce(sum(hits) filter (where host = '<blank>'), 0)::bigint as blank_hits, "
         + ", ".join(f"round(100.0 * (sum(hits) - sum(src_{c}_nb)) / sum(hits), 4) as blank_pct_{c}" for c in URL_COLS) + " from inv", *INV)
def _(h):
    return UP.inventory_summary(_inventory(h), URL_COLS)


@on_hits("coverage_report", """select count(*) as rows_total, sum(n)::bigint as hits_total, count(*) filter (where r <= 5) as rows_emitted, (sum(n) filter (where r <= 5))::bigint as hits_emitted, count(*) > 5 as truncated,
    round(100.0 * sum(n) filter (where r <= 5) / sum(n), 4) as hits_pct_covered from (select n, row_number() over (order by n desc, p) as r from (select coalesce(post_pagename, '') as p, count(*) as n from hits group by 1))""")
def _(h):
    n = h.groupBy(F.coalesce("post_pagename", F.lit("")).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return UP.coverage_report(n, 5, "n", "p")


def _unc():
    return F.col("category") & ~F.col("is_noise") & ~F.col("in_broad")


@on_hits("scope_filter_compare", "select f as filter, h::bigint as hits, u as urls, round(100.0 * h / (select sum(hits) from inv), 4) as hits_pct from (" + " union all ".join(
    f"select '{n}' as f, coalesce(sum(hits) filter (where {c}), 0) as h, {N(c)} as u from inv" for n, c in
    (("in_broad", "in_broad"), ("is_noise", "is_noise"), ("category", "category"), ("uncovered", "category and not is_noise and not in_broad"))) + ")", *INV)
def _(h):
    return UP.scope_filter_compare(_inventory(h), ["in_broad", "is_noise", "category"], _unc())


@on_hits("top_uncovered", """select host, path_prefix, lang, env, sum(hits)::bigint as hits from inv where category and not is_noise and not in_broad group by all order by hits desc, host, path_prefix limit 10""", *INV)
def _(h):
    return UP.top_uncovered(UP.url_rollup(_inventory(h), list(TAGS)), _unc(), 10).select("host", "path_prefix", "lang", "env", "hits")


def _scope_shares(h):
    return UP.scope_shares(h, U.url_host(U.host_path(url_of())), "rsid", "geo_country")


ALL_HOSTS = (URL, UHP, f"hosts as (select host, n, round(100.0 * n / sum(n) over (), 3) as pct, {ENV.format(h='host')} as env from "
             "(select string_split(hp, '/')[1] as host, count(*) as n from uhp where hp <> '' group by 1))")
EXCLUDED = ("%cms.example.com%",)
LOGIN_SQL = "regexp_matches(host, '(?i)portal|portail|login|auth|signin|member|sso')"
TIERS = (*ALL_HOSTS,
         "su as (select rsid as v, count(*) as n, round(100.0 * count(*) / (select count(*) from hits), 3) as pct from hits where trim(rsid) <> '' group by 1)",
         "ge as (select geo_country as v, count(*) as n, round(100.0 * count(*) / (select count(*) from hits), 3) as pct from hits where trim(geo_country) <> '' group by 1)",
         "th as (select * from hosts order by (env = 'prod') desc, n desc, host limit 1)",
         "mh as (select * from hosts h where env in ('prod', 'uat') and 100.0 * (select coalesce(sum(n), 0) from hosts g where g.env in ('prod', 'uat') and g.n > h.n) "
         "< 95.0 * (select sum(n) from hosts where env in ('prod', 'uat')))",
         "ts as (select * from su order by n desc, v limit 1)", "tg as (select * from ge order by n desc, v limit 1)")


@on_hits("scope_tiers", f"""select 'tight' as tier, 'suite' as part, v as value from ts union all select 'medium', 'suite', v from su where pct >= 1.0 union all select 'broad', 'suite', v from su
    union all select 'tight', 'include', '%' || host || '%' from th union all select 'medium', 'include', '%' || host || '%' from mh
    union all select 'tight', 'exclude', '%' || host || '%' from hosts where env <> 'prod' union all select 'medium', 'exclude', '%' || host || '%' from hosts where env = 'aem_authoring'
    union all select t, 'exclude', '{EXCLUDED[0]}' from (select unnest(['tight', 'medium', 'broad']) as t)
    union all select t, 'login', '%' || host || '%' from hosts, (select unnest(['tight', 'medium']) as t) where {LOGIN_SQL}
    union all select 'tight', 'country', v from tg union all select 'medium', 'country', v from ge where pct >= 1.0""", *TIERS)
def _(h):
    hosts, suites, countries, _ = _scope_shares(h)
    return UP.scope_tiers(hosts, suites, countries, EXCLUDED)


@on_hits("tier_coverage", """select tier, cov as hit_coverage_pct, round((select count(*) from hits) * cov / 100.0)::bigint as row_estimate from (
    select 'tight' as tier, round(least((select sum(pct) from ts), (select sum(pct) from th)), 3)::double as cov union all
    select 'medium', round(least((select sum(pct) from su where pct >= 1.0), (select sum(pct) from mh)), 3)::double union all select 'broad', 100.0::double)""", *TIERS)
def _(h):
    hosts, suites, _, rows = _scope_shares(h)
    return UP.tier_coverage(hosts, suites, rows)


PAGE_HOSTS = "pg as (select string_split(hp, '/')[1] as host, count(*) as n from parts where hp <> '' group by 1)"


@on_pages("unclassified_hosts", f"""select host, n, pct from (select host, n, round(100.0 * n / (select sum(n) from pg), 3) as pct, {ENV.format(h='host')} as env from pg)
    where env = 'prod' and pct >= 0.1 and pct < 1.0""", PARTS, PAGE_HOSTS)
def _(p):
    return UP.unclassified_hosts(UP.host_shares(p, U.url_host(U.host_path("url")))).select("host", "n", "pct")


@on_pages("referrer_hosts", "select string_split(hp, '/')[1] as host, count(*) as n from parts group by 1 order by n desc, host limit 25", PARTS)
def _(p):
    return UP.referrer_hosts(p, "url")


@on_hits("cid_vs_campaign", f"""select count(*) as rows, {N('cid')} as cid_rows, {N('camp')} as campaign_rows, {N('cid and camp')} as both, {N('cid and not camp')} as cid_only, {N('camp and not cid')} as campaign_only,
    {N('cid and campaign = $$abc$$')} as equal_when_both, round({N('cid and campaign = $$abc$$')} / {N('cid and camp')}, 9) as agreement
    from (select campaign, coalesce(lower(page_url) like '%?cid=%', false) as cid, campaign <> '' as camp from hits)""")
def _(h):
    return rounded(UP.cid_vs_campaign(h, "page_url", "campaign"), "agreement")


# ---------------------------------------------------------------- suites

SUITE_SQL = """select rsid as suite, count(*) as rows, min(hit_date) as first_day, max(hit_date) as last_day, count(distinct hit_date) as n_days, round(count(*) * 100.0 / (select count(*) from hits), 4) as share_pct,
    count(distinct hit_date) >= 30 as clears_30d, count(distinct hit_date) >= 90 as clears_90d from hits group by 1"""


@on_hits("suite_census", SUITE_SQL)
def _(h):
    return S.suite_census(h, "rsid", "hit_date")


@on_hits("suite_inventory", f"""select s.suite, rows, share_pct, m.monthly, t.top_hosts from ({SUITE_SQL}) s
    join (select rsid, string_agg(month || '=' || cast(n as string), ',' order by month) as monthly from (select rsid, strftime(hit_date, '%Y-%m') as month, count(*) as n from hits group by 1, 2) group by 1) m on m.rsid = s.suite
    join (select rsid, string_agg(host || '=' || cast(n as string), ',' order by n desc, host) as top_hosts from (select *, row_number() over (partition by rsid order by n desc, host) as r from
      (select rsid, string_split(hp, '/')[1] as host, count(*) as n from uhp where hp <> '' group by 1, 2)) where r <= 3 group by 1) t on t.rsid = s.suite""", URL, UHP)
def _(h):
    out = S.suite_inventory(h, "rsid", "hit_date", U.url_host(U.host_path(url_of())), 3)

    def flat(c, a, b):
        return F.array_join(F.transform(c, lambda x: F.concat(x[a], F.lit("="), x[b])), ",").alias(c)
    return out.select("suite", "rows", "share_pct", flat("monthly", "month", "hits"), flat("top_hosts", "host", "hits"))


NB = "round(avg((coalesce(trim({c}), '') <> '')::int), 9) as {c}".format


@on_hits("web_vs_app", f"""select *, case when any_url_rate >= 0.9 then 'web' when any_url_rate <= 0.1 then 'app_or_mixed' else 'mixed' end as verdict from (select rsid as suite, count(*) as rows, {NB(c='page_url')}, {NB(c='post_page_url')}, {NB(c='mobileappid')},
    round(avg((coalesce(trim(page_url), '') || coalesce(trim(post_page_url), '') <> '')::int), 9) as any_url_rate from hits group by 1)""")
def _(h):
    return rounded(S.web_vs_app(h, "rsid", ["page_url", "post_page_url"], ["mobileappid"]), "page_url", "post_page_url", "mobileappid", "any_url_rate")


SEGMENTS = """select rsid as suite, trim(string_split(brand_tag, '|')[1]) as brand, trim(string_split(brand_tag, '|')[2]) as lob, trim(string_split(brand_tag, '|')[3]) as segment, count(*) as n
    from hits where brand_tag <> '' group by 1, 2, 3, 4 order by n desc, 1, 2, 3, 4 limit 20"""


@on_hits("segment_triples", SEGMENTS)
def _(h):
    return S.segment_triples(h, "rsid", "brand_tag", "|", 20)


@on_hits("segment_triples_sketched", SEGMENTS)
def _(h):
    return S.segment_triples(h, "rsid", "brand_tag", "|", 20, sketched=True)


@on_hits("scope_sizing", f"""select count(*) as rows, {N('s')} as segment_scope, {N('u')} as url_scope, {N('s and u')} as both, {N('s and not u')} as segment_only, {N('u and not s')} as url_only,
    {N('brand_tag like $$%Core%$$')} as core_rows, {N('brand_tag like $$%Core%$$ and s')} as core_in_segment from (select brand_tag, brand_tag like 'ca-plan%' as s, {INC} and not {EXC} as u from urls)""", URL)
def _(h):
    return S.scope_sizing(h, P.brand_tag_match("brand_tag", "ca-plan"), P.scope_url(url_of(), INCLUDE, EXCLUDE), {"core": P.brand_tag_match("brand_tag", "core")})


@on_hits("value_rate_by_suite", "select rsid as suite, count(*) as rows, round(avg((brand_tag <> '')::int), 9) as populated, round(avg((brand_tag like '%Core%')::int), 9) as match_rate from hits group by 1")
def _(h):
    return rounded(S.value_rate_by_suite(h, "rsid", "brand_tag", P.brand_tag_match("brand_tag", "core")), "populated", "match_rate")


@on_hits("pagename_prefix_census", "select rsid as suite, string_split(post_pagename, ':')[1] as prefix, count(*) as n, row_number() over (partition by rsid order by count(*) desc, string_split(post_pagename, ':')[1])::int as rank from hits where post_pagename <> '' group by 1, 2")
def _(h):
    return S.pagename_prefix_census(h, "rsid", "post_pagename")


GEO = {"country": "geo_country", "region": "geo_region", "city": "geo_city", "language": "language"}


@on_hits("geo_distribution", " union all ".join(
    f"select '{lv}' as level, v as value, n, round(100.0 * n / t, 3) as pct, round(100.0 * sum(n) over (order by n desc, v rows unbounded preceding) / t, 3) as cumulative_pct from "
    f"(select {c} as v, count(*) as n, (select count(*) from hits) as t from hits where {c} <> '' group by 1 order by n desc, v limit 10)" for lv, c in GEO.items()))
def _(h):
    return S.geo_distribution(h, GEO, 10)


@on_hits("mobile_profile", f"""select count(*) as rows, {N('mobileappid <> $$$$ or coalesce(hit_source like $$sdk%$$, false)')} as mobile_hits, round(100.0 * {N('mobileappid <> $$$$ or coalesce(hit_source like $$sdk%$$, false)')} / count(*), 3) as mobile_pct from hits""")
def _(h):
    return S.mobile_share(h, "mobileappid", "hit_source")


@on_hits("mobile_tops", " union all ".join(f"(select '{c}' as column_name, {c} as value, count(*) as n from hits where {c} <> '' group by 2 order by 3 desc, 2 limit 5)" for c in ("mobileappid", "mobiledevice", "hit_source")))
def _(h):
    return S.mobile_tops(h, ["mobileappid", "mobiledevice", "hit_source"], 5)


@on_hits("mobile_families", """select 'app_metadata' as family, count(*) as columns, (count(*) filter (where filled > 0))::bigint as populated_columns from
    (select name, sum((coalesce(trim(value), '') <> '')::int) as filled from (select mobileappid, coalesce(mobiledevice, '') as mobiledevice from hits)
     unpivot include nulls (value for name in (mobileappid, mobiledevice)) group by name)""")
def _(h):
    return S.mobile_families(h)


# ---------------------------------------------------------------- links

LINKS = ["href", "link_name", "campaign"]


@on_hits("link_census", " union all ".join(
    f"select '{c}' as column_name, round(avg((v is not null)::int), 9) as nonblank_rate, count(distinct v) as distinct_values, cast(min(length(v)) as int) as len_min, cast(max(length(v)) as int) as len_max, "
    f"cast(quantile_disc(length(v), 0.5) as int) as len_p50, cast(quantile_disc(length(v), 0.95) as int) as len_p95, cast(quantile_disc(length(v), 0.99) as int) as len_p99 from (select nullif({c}, '') as v from hits)" for c in LINKS))
def _(h):
    return rounded(L.link_census(h, LINKS, exact=True), "nonblank_rate")


@on_hits("link_encoding", f"""select count(nullif(href, '')) as hrefs, {N('r like $$%?%$$')} as has_query, {N('r like $$%#%$$')} as has_fragment, {N("r like '%\\%2f%' escape '\\'")} as pct_encoded, {N("r like '%\\%3a%' escape '\\'")} as pct_3a,
    {N("r like '%\\%2f%' escape '\\'")} as pct_2f, {N('r like $$%goto=%$$')} as has_goto, {N("contains(r, 'ui_locales')")} as has_ui_locales,
    {N("href <> '' and coalesce(link_name, '') = ''")} as href_without_name, {N("coalesce(href, '') = '' and link_name <> ''")} as name_without_href from hrefs""", HREFS)
def _(h):
    return L.link_encoding(h, "href", "link_name", L.ENCODING_MARKS)


def _names_sql(r):
    if not r.link_name_garbled:
        return "0::bigint as name_true, 0::bigint as name_garbled"
    return f"{N(f'lower(link_name) = $${r.link_name.lower()}$$')} as name_true, {N(f'lower(link_name) = $${r.link_name_garbled.lower()}$$')} as name_garbled"


def _name_cond(r):
    names = [n.lower() for n in (r.link_name, r.link_name_garbled) if n]
    if not names:
        return "coalesce(link_name, '') = ''"
    return "lower(coalesce(link_name, '')) in (" + ", ".join(f"'{n}'" for n in names) + ")"


@on_hits("rule_compare", " union all ".join(
    f"select '{r.key}' as rule, {N(f'r = $${r.href.lower()}$$')} as exact, {N(f'starts_with(r, $${r.href.lower()}$$)')} as prefix, {N(f'string_split(r, $$?$$)[1] = $${r.href.lower().split(chr(63))[0]}$$')} as path, "
    f"{N(RULE_SQL[r.key])} as token, {N(RULE_SQL[r.key] + ' and ' + _name_cond(r))} as token_name, {_names_sql(r)} from hrefs" for r in RULES), HREFS)
def _(h):
    return L.rule_compare(h, RULES, "href", "link_name")


PATH_N = " + ".join(f"(string_split(r, '?')[1] = '{r.href.lower().split('?')[0]}')::int" for r in RULES)
TOKEN_N = " + ".join(f"({RULE_SQL[r.key]})::int" for r in RULES)


@on_hits("rule_collisions", f"""select 'path' as strategy, {PATH_N} as rules_matched, count(*) as hits from hrefs where href <> '' group by 2
    union all select 'token', {TOKEN_N}, count(*) from hrefs where href <> '' group by 2""", HREFS)
def _(h):
    return L.rule_collisions(h, RULES, "href", "link_name")


@on_hits("rule_daily", " union all ".join(f"select hit_date as date, '{k}' as metric_id, {N(s)} as value from hrefs group by 1" for k, s in RULE_SQL.items()), HREFS)
def _(h):
    return L.rule_daily(h, RULES, "href", "hit_date")


@on_hits("rule_unmatched", f"select href as value, count(*) as n from hrefs where href <> '' and not {ANY_SQL} group by 1 order by n desc, value limit 25", HREFS)
def _(h):
    return L.rule_unmatched(h, RULES, "href")


CTX = {"matched": "true", "wide": INC, "narrow": "url like '%plans.example.com%'", "page_on_login_host": "url like '%login.example.com%' or url like '%id.example.com%'",
       "href_to_login_host": "coalesce(r like '%login.example.com%' or r like '%id.example.com%', false)", "page_url_blank": "url = ''", "in_no_scope": f"not ({INC} or url like '%plans.example.com%')"}


@on_hits("rule_page_context", " union all ".join(f"select '{k}' as rule, " + ", ".join(f"{N(f'({s}) and ({c})')} as {n}" for n, c in CTX.items()) + " from uhrefs" for k, s in RULE_SQL.items()),
         URL, "uhrefs as (select *, lower(href) as r from urls)")
def _(h):
    u = url_of()
    return L.rule_page_context(h, RULES, "href", u, {"wide": P.like_any(u, INCLUDE), "narrow": P.like_any(u, INCLUDE[:1])},
                               P.like_any(u, LOGIN), P.like_any(F.lower("href"), LOGIN))


WAYS = f"ways as ({FOUR_SQL})"
WAY_NAMES = ["href_param", "href_host", "link_name", "page_url"]


def _ways():
    return U.lang_four_ways("href", "link_name", "page_url", **FOUR)


@on_hits("lang_counts", " union all ".join(f"select '{w}' as derivation, {w} as language, count(*) as hits from ways group by 2" for w in WAY_NAMES), "h0 as (select 1 from hits)", WAYS)
def _(h):
    return L.lang_counts(h, _ways())


@on_hits("lang_agreement", " union all ".join(
    f"select '{a}' as a, '{b}' as b, {N(f'{a} <> $$unknown$$ and {b} <> $$unknown$$')} as comparable, {N(f'{a} <> $$unknown$$ and {a} = {b}')} as agree, round({N(f'{a} <> $$unknown$$ and {a} = {b}')} / nullif({N(f'{a} <> $$unknown$$ and {b} <> $$unknown$$')}, 0), 9) as agreement from ways"
    for i, a in enumerate(WAY_NAMES) for b in WAY_NAMES[i + 1:]), WAYS)
def _(h):
    return rounded(L.lang_agreement(h, _ways()), "agreement")


@on_hits("lang_by_rule", " union all ".join(f"select '{k}' as rule, '{w}' as derivation, w.{w} as language, count(*) as hits from hrefs h join ways w on w.hit_id = h.hit_id where {s} group by 3"
                                            for k, s in RULE_SQL.items() for w in WAY_NAMES), HREFS, WAYS)
def _(h):
    return L.lang_by_rule(h, RULES, "href", _ways())


@on_hits("lang_disagreement", f"""select {N('c')} as comparable, {N('c and t <> l')} as disagree, round({N('c and t <> l')} * 100.0 / {N('c')}, 3) as disagree_pct from
    (select t, l, t is not null and l <> 'unknown' as c from (select case when lower(post_evar8) like 'fr%' then 'fr' when lower(post_evar8) like 'en%' then 'en' end as t, {HOST_LANG_SQL.format(u='url')} as l from urls))""", URL)
def _(h):
    return L.lang_disagreement(h, "post_evar8", U.lang_from_host(url_of(), HOST_LANGS))


# ---------------------------------------------------------------- populations

VISITS = f"visits as (select {VK} as vk, min(hit_date) as date, count(*) as hits, count(*) filter (where post_page_event = '0') as pvs from hits group by 1)"


def _visits(h):
    return O.visits_with_views(h, "hit_date", visit(), K.page_view_flag("page_marker"))


@on_hits("visit_shape", "select count(*) as visits, round(sum(pvs) / count(*), 9) as pv_per_visit, round(avg((pvs = 0)::int), 9) as share_eq_0, round(avg((pvs = 2)::int), 9) as share_eq_2 from visits", VISITS)
def _(h):
    return rounded(O.visit_shape(_visits(h)), "pv_per_visit", "share_eq_0", "share_eq_2")


@on_hits("visit_buckets", "select case when pvs = 0 then '0' when pvs = 1 then '1' when pvs = 2 then '2' when pvs <= 5 then '3-5' else '6+' end as bucket, count(*) as visits from visits group by 1", VISITS)
def _(h):
    return O.visit_buckets(_visits(h))


@on_hits("visit_shape_daily", "select date, count(*) as visits, round(sum(pvs) / count(*), 9) as pv_per_visit, round(avg((pvs = 2)::int), 9) as share_eq_2 from visits group by 1", VISITS)
def _(h):
    return rounded(O.visit_shape_daily(_visits(h)), "pv_per_visit", "share_eq_2")


@on_hits("visitor_grain", f"select hit_date as date, count(distinct mcvisid) as by_id, count(distinct {PAIR}) as by_pair from hits group by 1")
def _(h):
    return O.visitor_grain(h, "hit_date", F.col("mcvisid"), pair())


POPS = (HREFS, f"pop as (select *, {VK} as vk, {PAIR} as pr from hrefs)", f"q as (select distinct vk from pop where {ANY_SQL})",
        "pops as (select 'qualified' as population, * from pop where vk in (select vk from q) union all select 'paid', * from pop where campaign = 'abc')",
        "pdays as (select population, hit_date as date, count(*) as hits, count(*) filter (where post_page_event = '0') as page_views, count(distinct vk) as visits, count(distinct mcvisid) as visitors, count(distinct pr) as visitors_pair from pops group by 1, 2)")


def _populations(h):
    flagged = flag_qualified(h, visit(), P.any_rule(RULES, "href"))
    return O.population_series(flagged, "hit_date", {"qualified": F.col("qualified"), "paid": F.col("campaign") == "abc"},
                               visit(), F.col("mcvisid"), pair(), K.page_view_flag("page_marker"))


@on_hits("population_series", "select * from pdays", *POPS)
def _(h):
    return _populations(h)


@on_hits("population_verdict", f"""select population, percentile_disc(0.5) within group (order by visits desc) as median_visits, min(visits) as min_visits, max(visits) as max_visits, {N('visits < 100')} as days_below, {N('visits = 0')} as days_zero, count(*) as days from pdays group by 1""", *POPS)
def _(h):
    return O.population_verdict(_populations(h))


@on_hits("rule_visit_contrib", " union all ".join(f"select '{k}' as rule, count(distinct {VK}) filter (where {s}) as visits from hrefs" for k, s in RULE_SQL.items()), HREFS)
def _(h):
    return O.rule_visit_contrib(h, RULES, "href", visit())


@on_hits("key_cardinality", f"select count(distinct post_visid_high) as hi, count(distinct post_visid_low) as lo, count(distinct visit_num) as num, count(distinct {VK}) as visit from hits")
def _(h):
    return O.key_cardinality(h, {"hi": F.col("post_visid_high"), "lo": F.col("post_visid_low"), "num": F.col("visit_num"), "visit": visit()}, exact=True)


@on_hits("tag_vs_rules", f"""select count(*) as rows, {N('t')} as tagged_hits, {N('q')} as rule_hits, {N('t and q')} as both_hits, {N('q and not t')} as rule_untagged_hits, any_value(a) as rule_visits, any_value(b) as tagged_visits, any_value(ab) as both_visits, any_value(a_) as rule_only_visits, any_value(b_) as tagged_only_visits
    from (select brand_tag like 'ca-plan%' as t, {ANY_SQL} as q from hrefs), (select {N('q')} as a, {N('t')} as b, {N('q and t')} as ab, {N('q and not t')} as a_, {N('t and not q')} as b_ from (select {VK} as vk, bool_or(brand_tag like 'ca-plan%') as t, bool_or({ANY_SQL}) as q from hrefs group by 1))""", HREFS)
def _(h):
    return O.tag_vs_rules(h, P.brand_tag_match("brand_tag", "ca-plan"), RULES, "href", visit())


@on_hits("rule_tagged_share", " union all ".join(f"select '{k}' as rule, {N(s)} as matched, {N(s + ' and brand_tag like $$ca-plan%$$')} as also_tagged, round({N(s + ' and brand_tag like $$ca-plan%$$')} / nullif({N(s)}, 0), 9) as tagged_share from hrefs" for k, s in RULE_SQL.items()), HREFS)
def _(h):
    return rounded(O.rule_tagged_share(h, P.brand_tag_match("brand_tag", "ca-plan"), RULES, "href"), "tagged_share")
