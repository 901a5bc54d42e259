"""Scalar functions and projections, one row per hit or page."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import events as E
from ..functions import keys as K
from ..functions import text as T
from ..functions import time as TM
from ..functions import url as U
from ..sources import adapters as A
from .base import on_hits, on_orders, on_pages, query

# ---------------------------------------------------------------- text and labels


@on_hits("nonblank", "select hit_id, page_url is not null and trim(page_url) <> '' as ok from hits")
def _(h):
    return h.select("hit_id", T.nonblank("page_url").alias("ok"))


@on_hits("qcol", "select hit_id, post_evar4 as v from hits")
def _(h):
    dotted = h.withColumnRenamed("post_evar4", "visit.evar4")
    return dotted.select("hit_id", T.qcol("visit.evar4").alias("v"))


@on_hits("pick_col", "select hit_id, post_evar8 as picked from hits")
def _(h):
    return h.select("hit_id", F.col(T.pick_col(h, "missing", "POST_EVAR8")).alias("picked"))


@on_hits("evar", "select hit_id, post_evar8 as tag, post_evar4 as category from hits")
def _(h):
    """Processed column first, raw column where there is no processed one."""
    raw = h.withColumnRenamed("post_evar8", "evar8")
    return raw.select("hit_id", F.col(T.evar(raw, 8)).alias("tag"), F.col(T.evar(raw, 4)).alias("category"))


@on_hits("split_part", """select hit_id, nullif(string_split(post_pagename, ':')[2], '') as second,
    string_split(post_pagename, ':')[9] as ninth from hits""")
def _(h):
    return h.select(
        "hit_id", T.split_part("post_pagename", ":", 2).alias("second"),
        T.split_part("post_pagename", ":", 9).alias("ninth"))


@on_hits("brand_triple", """select hit_id, trim(string_split(brand_tag, '|')[1]) as brand,
    trim(string_split(brand_tag, '|')[2]) as lob, trim(string_split(brand_tag, '|')[3]) as segment
    from hits""")
def _(h):
    return h.select("hit_id", T.brand_triple("brand_tag", "|").alias("t")).select("hit_id", "t.*")


@query("slug", """select distinct s, trim(regexp_replace(lower(s), '[^a-z0-9]+', '-', 'g'), '-') as slug
    from (select p_brand || ': ' || p_type || ' / ' || p_name || '!' as s from part)""")
def _(spark, d):
    s = A.table(spark, d, "part").select(
        F.concat("p_brand", F.lit(": "), "p_type", F.lit(" / "), "p_name", F.lit("!")).alias("s")).distinct()
    return s.select("s", T.slug("s").alias("slug"))


@on_hits("severity", """select hit_id, case when amount/10 >= 12 then 'critical' when amount/10 >= 8 then 'major'
    when amount/10 >= 5 then 'minor' else 'warn' end as severity from hits""")
def _(h):
    return h.select("hit_id", T.severity(F.col("amount") / 10).alias("severity"))


@on_hits("anomaly_id", """select hit_id, concat_ws(':', post_evar4, cast(hit_date as string), 'univariate') as anomaly_id
    from hits""")
def _(h):
    return h.select(
        "hit_id", T.anomaly_id(F.col("post_evar4"), F.col("hit_date"), F.lit("univariate")).alias("anomaly_id"))


@on_hits("log_transform", """select hit_id, round(ln(1 + amount), 8) as logged,
    round(amount, 6) as back from hits""")
def _(h):
    v = T.log_transform(F.col("amount"), F.lit(True))
    return h.select("hit_id", F.round(v, 8).alias("logged"),
                    F.round(T.log_inverse(v, F.lit(True)), 6).alias("back"))


@on_hits("code_label", """select hit_id, case language when '45' then 'English' when '39' then 'French'
    else 'Other' end as label from hits""")
def _(h):
    return h.select("hit_id", T.code_label("language", {"45": "English", "39": "French"}).alias("label"))


@on_hits("iso3_upper", "select hit_id, upper(geo_country) as country from hits")
def _(h):
    return h.select("hit_id", T.iso3_upper("geo_country").alias("country"))


# ---------------------------------------------------------------- urls

URL_COLS = ("page_url", "visit_start_page_url", "post_page_url")
COALESCED = "lower(coalesce(nullif(trim(page_url), ''), nullif(trim(visit_start_page_url), ''), nullif(trim(post_page_url), ''), ''))"
HP = "regexp_extract(regexp_replace(lower(url), '^[a-z]+://', ''), '^([^?#]*)', 1)"
PARTS = f"parts as (select hit_id, hit_date, url, {HP} as hp from phits)"
PATHS = ("paths as (select *, regexp_extract(hp, '^([^/]+)', 1) as host, "
         "case when hp like '_%/%' then substr(hp, strpos(hp, '/')) else '/' end as path from parts)")
GEN = ("array_to_string(list_transform(string_split(path, '/'), lambda s: case when "
       "regexp_full_match(s, '[0-9]{4,}|[0-9a-f]{16,}|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}') "
       "then '{id}' else s end), '/')")


@on_hits("url_coalesce", f"select hit_id, {COALESCED} as url from hits")
def _(h):
    return h.select("hit_id", U.url_coalesce(*URL_COLS).alias("url"))


@on_hits("url_coalesce_raw", "select hit_id, lower(case when page_url is null then post_page_url else page_url end) as url from hits")
def _(h):
    return h.select("hit_id", U.url_coalesce_raw("page_url", "post_page_url").alias("url"))


@on_pages("url_strip", """select hit_id, rtrim(regexp_replace(regexp_extract(
    regexp_replace(lower(trim(url)), '^[a-z]+://', ''), '^([^?#]*)', 1), '^www[.]', ''), '/') as url from phits""")
def _(p):
    return p.select("hit_id", U.url_strip("url").alias("url"))


@on_pages("strip_query", "select hit_id, string_split(string_split(url, '?')[1], '#')[1] as url from phits")
def _(p):
    return p.select("hit_id", U.strip_query("url").alias("url"))


@on_pages("url_host", "select hit_id, string_split(hp, '/')[1] as host from parts", PARTS)
def _(p):
    return p.select("hit_id", U.url_host(U.host_path("url")).alias("host"))


@on_pages("url_path", "select hit_id, path from paths", PARTS, PATHS)
def _(p):
    return p.select("hit_id", U.path_bucket(U.host_path("url")).alias("path"))


def _long_path(p):
    return F.concat(U.url_path(U.host_path("url")), F.lit("/"), F.md5("url"), F.lit("/"),
                    F.col("hit_id") * 977, F.lit("/x12"))


LONG = "long_paths as (select hit_id, host, path || '/' || md5(url) || '/' || cast(hit_id * 977 as string) || '/x12' as path from paths)"


@on_pages("path_generalize_ids", f"select hit_id, {GEN} as path from long_paths", PARTS, PATHS, LONG)
def _(p):
    return p.select("hit_id", U.path_generalize_ids(_long_path(p)).alias("path"))


@on_pages("path_prefix", f"""select hit_id, case when path = '/' then '/' else
    array_to_string(list_filter(string_split(path, '/')[1:3], lambda s, i: i <= 2 or s <> ''), '/') end as prefix
    from (select hit_id, {GEN} as path from long_paths)""", PARTS, PATHS, LONG)
def _(p):
    return p.select("hit_id", U.path_prefix(U.path_generalize_ids(_long_path(p)), 2).alias("prefix"))


MIXED_HOST = "hosts as (select hit_id, case k % 6 when 0 then 'author-x.example.com' when 1 then 'uat.example.com' when 2 then 'preview.example.com' when 3 then 'box.local' when 4 then 'cms.adobeaemcloud.com' else 'www.example.com' end as host from (select *, cast(visit_page_num as int) as k from hits))"


def _mixed_host(h):
    k = F.col("visit_page_num").cast("int") % 6
    host = (F.when(k == 0, "author-x.example.com").when(k == 1, "uat.example.com")
            .when(k == 2, "preview.example.com").when(k == 3, "box.local")
            .when(k == 4, "cms.adobeaemcloud.com").otherwise("www.example.com"))
    return h.select("hit_id", host.alias("host"))


@on_hits("host_env_tag", """select hit_id, case when host like 'author-%' or host like '%adobeaemcloud%' then 'aem_authoring'
    when host like 'uat.%' then 'uat' when host like 'preview%' then 'stage' when host like '%.local' then 'other'
    else 'prod' end as env from hosts""", MIXED_HOST)
def _(h):
    return _mixed_host(h).select("hit_id", U.host_env_tag("host").alias("env"))


@on_hits("env_tag_coarse", """select hit_id, case when host like '%adobeaemcloud%' then 'aem'
    when host like 'author-%' or host like 'uat.%' or host like 'preview%' then 'nonprod' else 'prod' end as env
    from hosts""", MIXED_HOST)
def _(h):
    return _mixed_host(h).select("hit_id", U.env_tag_coarse("host").alias("env"))


HOST_LANGS = {"fr": r"regimes\.example\.net", "en": r"plans\.example\.com"}
HOST_LANG_SQL = ("case when {u} like '%://regimes.example.net%' then 'fr' "
                 "when {u} like '%://%plans.example.com%' then 'en' else 'unknown' end")
PATH_LANGS = {"fr": "(^|/)fr(/|$)", "en": "(^|/)en(/|$)"}


@on_hits("lang_from_host", f"select hit_id, {HOST_LANG_SQL.format(u=COALESCED)} as lang from hits")
def _(h):
    return h.select("hit_id", U.lang_from_host(U.url_coalesce(*URL_COLS), HOST_LANGS).alias("lang"))


@on_pages("lang_path_then_host", """select hit_id, case when list_contains(string_split(path, '/'), 'fr') then 'fr'
    when list_contains(string_split(path, '/'), 'en') then 'en' when host like '%.net' then 'fr' else 'unknown' end as lang
    from paths""", PARTS, PATHS)
def _(p):
    hp = U.host_path("url")
    return p.select("hit_id", U.lang_path_then_host(
        U.url_path(hp), U.url_host(hp), PATH_LANGS, {"fr": r"\.net$"}).alias("lang"))


FOUR = dict(href_hosts={"fr": "regimes", "en": r"example\.com"},
            names={"fr": ["Se connecter", "Régimes", "RÃ©gimes"], "en": ["Sign in"]},
            page_patterns={"fr": "/fr/|regimes", "en": "/en/"})
FOUR_SQL = """select hit_id,
    case regexp_extract(lower(href), '[?&](ui_locales|hl|l)=([a-z][a-z])', 2) when 'fr' then 'fr' when 'en' then 'en' else 'unknown' end as href_param,
    case when lower(href) like '%regimes%' then 'fr' when lower(href) like '%example.com%' then 'en' else 'unknown' end as href_host,
    case when lower(trim(link_name)) in ('se connecter', 'régimes', 'rã©gimes') then 'fr'
         when lower(trim(link_name)) = 'sign in' then 'en' else 'unknown' end as link_name,
    case when lower(page_url) like '%/fr/%' or lower(page_url) like '%regimes%' then 'fr'
         when lower(page_url) like '%/en/%' then 'en' else 'unknown' end as page_url
    from hits"""


@on_hits("lang_four_ways", FOUR_SQL)
def _(h):
    ways = U.lang_four_ways("href", "link_name", "page_url", **FOUR)
    return h.select("hit_id", *[c.alias(n) for n, c in ways.items()])


@on_hits("lang_from_value", """select hit_id, case when lower(post_evar8) like 'fr%' then 'fr'
    when lower(post_evar8) like 'en%' then 'en' end as lang from hits""")
def _(h):
    return h.select("hit_id", U.lang_from_value("post_evar8").alias("lang"))


@on_hits("query_param", "select hit_id, case when page_url like '%?cid=%' then 'Abc' else '' end as cid from hits")
def _(h):
    return h.select("hit_id", U.query_param("page_url", "cid").alias("cid"))


@on_hits("pct_decode4", "select hit_id, replace(lower(href), '%2f', '/') as href from hits")
def _(h):
    return h.select("hit_id", U.pct_decode4(F.lower("href")).alias("href"))


@on_hits("href_elide", """select hit_id, case when strpos(href, '?') = 0 then href else string_split(href, '?')[1] || '?' ||
    array_to_string(list_transform(string_split(substr(href, strpos(href, '?') + 1), '&'),
      lambda kv: case when strpos(kv, '=') > 0 then string_split(kv, '=')[1] || '=<v>' else kv end), '&') end as href
    from hits""")
def _(h):
    return h.select("hit_id", U.href_elide("href").alias("href"))


# ---------------------------------------------------------------- time

@on_hits("event_ts", """select hit_id, strftime(coalesce(try_cast(date_time as timestamp),
    make_timestamp(try_cast(hit_time_gmt as bigint) * 1000000)), '%Y-%m-%d %H:%M:%S') as ts from hits""")
def _(h):
    """Over all rows; text that the strict form throws on is nulled first (the throw itself has a test)."""
    strict = TM.event_ts(F.nullif("date_time", F.lit("0")), F.nullif("hit_time_gmt", F.lit("")))
    return h.select("hit_id", F.date_format(strict, "yyyy-MM-dd HH:mm:ss").alias("ts"))


SAFE_TS = """select hit_id, strftime(coalesce(try_cast(date_time as timestamp),
    make_timestamp(try_cast(hit_time_gmt as bigint) * 1000000){extra}), '%Y-%m-%d %H:%M:%S') as ts from hits"""


@on_hits("event_ts_safe", SAFE_TS.format(extra=""))
def _(h):
    return h.select("hit_id", F.date_format(TM.event_ts_safe("date_time", "hit_time_gmt"),
                                            "yyyy-MM-dd HH:mm:ss").alias("ts"))


@on_hits("event_ts_chain", SAFE_TS.format(extra=", cast(hit_date as timestamp)"))
def _(h):
    return h.select("hit_id", F.date_format(TM.event_ts_chain("date_time", "hit_time_gmt", "hit_date"),
                                            "yyyy-MM-dd HH:mm:ss").alias("ts"))


@on_hits("local_ts", """select hit_id, strftime(make_timestamp((try_cast(epoch_text as bigint) - 18000) * 1000000), '%Y-%m-%d %H:%M:%S') as ts from hits""")
def _(h):
    return h.select("hit_id", F.date_format(TM.local_ts("epoch_text", "America/Toronto"),
                                            "yyyy-MM-dd HH:mm:ss").alias("ts"))


@on_orders("trunc_period", """select hit_id, hit_date as d, cast(date_trunc('week', hit_date) as date) as w from ohits""")
def _(o):
    return o.select("hit_id", TM.trunc_period("hit_date").alias("d"),
                    TM.trunc_period("hit_date", "weekly").alias("w"))


@on_orders("month_key", "select hit_id, strftime(hit_date, '%Y-%m') as m from ohits")
def _(o):
    return o.select("hit_id", TM.month_key("hit_date").alias("m"))


# ---------------------------------------------------------------- events

IDS_SQL = ("list_filter(list_transform(string_split({c}, ','), lambda t: trim(string_split(t, '=')[1])), "
           "lambda t: t <> '')")


@on_hits("event_list_normalize", f"select hit_id, coalesce(array_to_string({IDS_SQL.format(c='raw_event_list')}, ','), case when raw_event_list is null then null else '' end) as ids from hits")
def _(h):
    return h.select("hit_id", E.event_list_normalize("raw_event_list").alias("ids"))


@on_hits("event_tokens", """select hit_id, trim(string_split(t, '=')[1]) as id, try_cast(string_split(t, '=')[2] as double) as value
    from (select hit_id, unnest(string_split(raw_event_list, ',')) as t from hits) where trim(t) <> ''""")
def _(h):
    return h.select("hit_id", F.explode(E.event_tokens("raw_event_list")).alias("t")).select("hit_id", "t.*")


@on_hits("event_presence", f"""select distinct hit_id, id from
    (select hit_id, unnest({IDS_SQL.format(c='raw_event_list || chr(44) || raw_event_list')}) as id from hits)""")
def _(h):
    twice = h.withColumn("raw_event_list", F.concat("raw_event_list", F.lit(","), "raw_event_list"))
    return twice.select("hit_id", F.explode(E.event_presence("raw_event_list")).alias("id"))


@on_hits("event_contains", "select hit_id, ',' || coalesce(post_event_list, '') || ',' like '%,20,%' as has from hits")
def _(h):
    return h.select("hit_id", E.event_contains("post_event_list", "20").alias("has"))


LABEL_CASE = """case id when '20' then 'Campaign View' when '228' then 'Quote Start' when '500' then 'std five hundred'
    when '269' then 'pending confirmation' when '103' then 'Instance of eVar4' when '10036' then 'Instance of eVar137'
    else 'unknown event' end"""


@on_hits("event_label", f"""select id, {LABEL_CASE} as label, count(distinct hit_id) as n from
    (select hit_id, unnest({IDS_SQL.format(c='raw_event_list')}) as id from hits) group by id""")
def _(h):
    ids = h.select(F.explode(E.event_presence("raw_event_list")).alias("id")).groupBy("id").agg(
        F.count(F.lit(1)).alias("n"))
    lookup = h.sparkSession.createDataFrame([("20", "Campaign View"), ("228", "Quote Start")],
                                            "event_id string, label string")
    return E.with_event_label(ids, "id", lookup, {"500": "std five hundred"}, ("269",))


# ---------------------------------------------------------------- keys

@on_hits("pseudonymize", "select hit_id, sha256('secret' || mcvisid) as pseudo from hits")
def _(h):
    return h.select("hit_id", K.pseudonymize("mcvisid", "secret").alias("pseudo"))


@on_hits("key_plain", "select hit_id, concat_ws('_', post_visid_high, post_visid_low, visit_num) as key from hits")
def _(h):
    return h.select("hit_id", K.key_plain("post_visid_high", "post_visid_low", "visit_num").alias("key"))


@on_hits("key_null_safe", """select hit_id, case when post_visid_high is null and post_visid_low is null then null
    else coalesce(post_visid_high, '␀') || '_' || coalesce(post_visid_low, '␀') end as key from hits""")
def _(h):
    return h.select("hit_id", K.key_null_safe("post_visid_high", "post_visid_low").alias("key"))


@on_hits("page_view_flag", "select hit_id, 1 as all_hits, cast(coalesce(post_page_event = '0', false) as int) as marked from hits")
def _(h):
    return h.select("hit_id", K.page_view_flag().alias("all_hits"), K.page_view_flag("page_marker").alias("marked"))


@on_hits("page_view_flag_fallback", """select hit_id, cast(coalesce(post_page_event = '0', false) as int) as marker,
    cast(coalesce(trim(post_pagename) <> '', false) as int) as pagename, 1 as neither from hits""")
def _(h):
    def best(df):
        return K.page_view_flag_fallback(df)[0]
    no_marker = h.drop("post_page_event")
    return h.select("hit_id", best(h).alias("marker"), best(no_marker).alias("pagename"),
                    best(no_marker.drop("post_pagename")).alias("neither"))


@on_hits("pv_bucket", """select mcvisid, case when count(*) = 1 then '1' when count(*) = 2 then '2'
    when count(*) <= 5 then '3-5' else '6+' end as bucket from hits group by mcvisid, hit_date""")
def _(h):
    per = h.groupBy("mcvisid", "hit_date").agg(F.count(F.lit(1)).alias("n"))
    return per.select("mcvisid", K.pv_bucket("n").alias("bucket"))


@on_hits("dim_label", """select column_name, case column_name when 'post_evar4' then 'Category' when 'post_evar8' then 'Language tag' end as label,
    pop_pct from (select 'post_evar4' as column_name, round(100.0 * count(nullif(trim(post_evar4), '')) / count(*), 3) as pop_pct from hits
    union all select 'post_evar8', round(100.0 * count(nullif(trim(post_evar8), '')) / count(*), 3) from hits
    union all select 'campaign', round(100.0 * count(nullif(trim(campaign), '')) / count(*), 3) from hits)""")
def _(h):
    from ..operators.census import population_census, with_dim_label
    labels = h.sparkSession.createDataFrame(
        [("evar", 4, "Category"), ("evar", 8, "Language tag")], "family string, number int, label string")
    census = population_census(h.select("post_evar4", "post_evar8", "campaign"))
    return with_dim_label(census, labels).select("column_name", "label", "pop_pct")
