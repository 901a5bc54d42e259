"""Maps generic event and order tables onto the hit model.

The derivations are plain SQL text, valid in Spark and in the checking engine alike, so a
check and the query it checks start from the same hits.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_K = "cast(regexp_extract(props, '[0-9]+', 0) as int)"
_HOUR = "cast(extract(hour from ts) as int)"
_EPOCH_DAY = {"spark": "datediff(cast(ts as date), date '1970-01-01')",
              "duckdb": "date_diff('day', date '1970-01-01', cast(ts as date))"}
_EVENT_CODE = ("case event_type when 'view' then '20' when 'click' then '500' "
               "when 'signup' then '10036' when 'purchase' then '228' else '103' end")
_LANG_DIR = "case when k % 3 = 0 then 'fr' when k % 3 = 1 then 'en' else 'plans' end"

HIT_COLUMNS = {
    "hit_id": "event_id",
    "hit_date": "cast(ts as date)",
    "date_time": "case when k = 96 then '0' else substr(cast(ts as string), 1, 19) end",
    "hit_time_gmt": "case when k = 95 then '' else cast(epoch_day * 86400 + h * 3600 + 18000 as string) end",
    "epoch_text": "cast(epoch_day * 86400 + h * 3600 + k as string)",
    "load_date": "cast(ts as date) + cast(case when k < 60 then 1 when k < 90 then 2 else 5 end as int)",
    "raw_event_list": "case when k = 7 then null when k = 8 then '' else "
                      "concat(case when k < 95 then ' 10036=1 ,' else '' end, code, '=', cast(value as string), "
                      "case when k % 3 = 0 then ',269' else '' end, case when k % 4 = 0 then ',20,,504=x' else '' end) end",
    "post_event_list": "case when k = 7 then null when k = 8 then '' else "
                       "concat(case when k < 95 then '10036,' else '' end, code, "
                       "case when k % 3 = 0 then ',269' else '' end, case when k % 4 = 0 then ',20,504' else '' end) end",
    "mcvisid": "case when k = 41 then null else cast(user_id as string) end",
    "post_visid_high": "case when k = 17 then null else cast(user_id % 7 as string) end",
    "post_visid_low": "case when k in (17, 18) then null else cast(user_id as string) end",
    "visit_num": "cast(cast(floor(h / 6) as int) as string)",
    "visit_start_time_gmt": "cast(epoch_day * 86400 + cast(floor(h / 6) as int) * 21600 as string)",
    "visit_page_num": "cast(k as string)",
    "post_page_event": "case event_type when 'view' then '0' when 'click' then '1' when 'error' then 'bogus' "
                       "when 'signup' then null else '0' end",
    "language": "case k % 4 when 0 then '45' when 1 then '39' when 2 then '38' else '' end",
    "post_pagename": "case when k >= 93 then '' when k = 92 then null else concat('site:', event_type, ':', cast(k % 6 as string)) end",
    "post_evar4": "case k % 8 when 0 then 'hd' when 1 then 'travel' when 2 then 'life' when 3 then 'home' "
                  "when 4 then 'obscure' when 5 then '' when 6 then null else 'hd' end",
    "post_evar8": "case k % 5 when 0 then 'FR-ca' when 1 then 'en-CA' when 2 then 'English' when 3 then '' else null end",
    "rsid": "case when k = 99 then 'suite_c' when user_id % 5 = 0 then 'suite_b' else 'suite_a' end",
    "exclude_hit": "case when k % 20 = 0 then '4' when k % 31 = 0 then 'x' when k % 37 = 0 then null else '0' end",
    "hit_source": "case when k % 25 = 3 then '5' when k % 29 = 0 then null when k % 23 = 0 then 'sdk_ios' else '1' end",
    "page_url": "case when k % 11 = 0 then '' when k % 13 = 0 then null else concat("
                "case when k % 2 = 0 then 'https://' else 'HTTP://' end, "
                "case k % 6 when 0 then 'www.plans.example.com' when 1 then 'uat.plans.example.com' "
                "when 2 then 'plans.example.com' when 3 then 'login.example.com' when 4 then 'regimes.example.net' "
                "else 'old.example.org' end, '/', " + _LANG_DIR + ", '/', event_type, '/', cast(user_id * 137 as string), "
                "case when k % 7 = 0 then '?cid=Abc&x=1' when k % 7 = 1 then '#top' when k % 7 = 2 then '/' else '' end) end",
    "post_page_url": "case when k % 3 = 0 then '' else concat('https://www.plans.example.com/', " + _LANG_DIR +
                     ", '/', event_type, '/', cast(user_id * 137 as string)) end",
    "visit_start_page_url": "case when k % 5 = 0 then null else concat('https://regimes.example.net/fr/', event_type) end",
    "href": "case when k % 4 = 3 then '' when k % 4 = 2 then null else concat('https://id.example.com/', "
            "case event_type when 'view' then 'signin?goto=%2fmember' when 'click' then 'signin?goto=%2fjoin' "
            "when 'signup' then 'advisor?x=1' when 'purchase' then 'store/app?id=5' else 'help' end, "
            "'&ui_locales=', case when k % 3 = 0 then 'fr' when k % 3 = 1 then 'EN' else 'de' end, "
            "case when k % 9 = 0 then '&hl=en' else '' end) end",
    "link_name": "case when k % 6 = 0 then 'Se connecter' when k % 6 = 1 then 'Sign in' when k % 6 = 2 then '' "
                 "when k % 6 = 3 then 'RÃ©gimes' when k % 6 = 4 then null else 'Régimes' end",
    "brand_tag": "case when k % 10 = 9 then '' when k % 10 = 8 then 'Other | retail' else "
                 "concat('ca-plan | group | ', case when k % 2 = 0 then 'Core' else 'Extra' end) end",
    "campaign": "case when k % 7 = 0 then 'abc' when k % 7 = 3 then 'mail' else '' end",
    "geo_country": "case when k % 9 = 0 then 'usa' when k % 9 = 1 then '' else 'can' end",
    "geo_region": "case k % 3 when 0 then 'on' when 1 then 'qc' else 'bc' end",
    "geo_city": "concat('city', cast(k % 12 as string))",
    "mobileappid": "case when k % 12 = 5 then concat('app', cast(k % 2 as string)) else '' end",
    "mobiledevice": "case when k % 12 = 5 then concat('phone', cast(k % 5 as string)) else null end",
    "ref_type": "cast(k % 5 as string)",
    "browser": "case when epoch_day = 19745 and k < 50 then '' else cast(user_id % 9 as string) end",
    "va_closer_id": "case when epoch_day >= 19752 and k < 30 then 'new' when k < 60 then '1' else '' end",
    "amount": "value",
}
# An order line seen as a hit: long calendar (years) with gaps, for the time-series operators.
ORDER_HIT_COLUMNS = {
    "hit_id": "o_orderkey",
    "hit_date": "cast(o_orderdate as date)",
    "post_event_list": "substr(o_orderpriority, 1, 1)",
    "mcvisid": "cast(o_custkey as string)",
    "post_visid_high": "o_orderstatus",
    "post_visid_low": "cast(o_custkey as string)",
    "visit_num": "'1'",
    "post_page_event": "'0'",
    "post_pagename": "o_orderpriority",
    "language": "o_orderstatus",
}


PAGE_HIT_COLUMNS = {
    "hit_id": "page_id",
    "url": "url",
    "hit_date": "date '2024-01-01' + cast(page_id % 40 as int)",
    "html_lang": "regexp_extract(html, 'lang=\"([a-z]+)\"', 1)",
}


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{expr} as {name}" for name, expr in columns.items()]


def _derived(dialect: str) -> list[str]:
    return ["*", f"{_K} as k", f"{_HOUR} as h", f"{_EPOCH_DAY[dialect]} as epoch_day",
            f"{_EVENT_CODE} as code"]


def event_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hit per ``events`` row; Catalyst prunes whatever a query does not read."""
    ev = table(spark, sf_dir, "events")
    return ev.selectExpr(*_derived("spark")).selectExpr(*_select(HIT_COLUMNS))


def order_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_select(ORDER_HIT_COLUMNS))


def page_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hit per crawled page: realistic urls, days spread over a month."""
    return table(spark, sf_dir, "pages").selectExpr(*_select(PAGE_HIT_COLUMNS))


def hits_sql(name: str = "hits") -> str:
    """CTE text giving the checking engine the same hits as :func:`event_hits`."""
    return (f"{name} as (select {', '.join(_select(HIT_COLUMNS))} "
            f"from (select {', '.join(_derived('duckdb'))} from events) e)")


def order_hits_sql(name: str = "ohits") -> str:
    return f"{name} as (select {', '.join(_select(ORDER_HIT_COLUMNS))} from orders)"


def page_hits_sql(name: str = "phits") -> str:
    return f"{name} as (select {', '.join(_select(PAGE_HIT_COLUMNS))} from pages)"
