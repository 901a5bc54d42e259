"""Secret scan with linking of multipart credentials.

Strong spans are found by pattern and always reported. Weak candidates (an account name, a bare
40-character key, an endpoint) mean little alone: each is reported only if a complementary part of a
credential lies within ``reach`` code points of it in the same text. That is an interval join: parts
are dealt into buckets of ``reach`` code points, each bucket keeps only its least start and greatest
end per class of part, and a candidate looks up the buckets that its own interval touches. Rows grow
with the number of spans, never with their pairs.

Null texts count as empty and have no spans. Repeated rows get the same spans, one row out for each
row in. Ties in start are ordered by kind as listed. An empty table gives an empty result. Columns
besides ``id`` and ``text`` are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bind
from ..sources.scratch import materialize
from .common import digest, positions, row_key, whole

# The patterns of each kind, in order of listing, and the least length of what counts.
VALUE = "[A-Za-z0-9+/_.=-]+"
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?(" + VALUE + ")"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
ACCOUNT = "(?i)(access_?key_?id|client_?id|user_?name|user|login)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9_.@-]+)"
KEY40 = "[A-Za-z0-9/+]{40,}"
ENDPOINT = "https?://[A-Za-z0-9.:_/-]+"
LEAST_VALUE = 6
REACH = 200

KINDS = ("assign", "access", "hex", "account", "key40", "endpoint")
STRONG, WEAK = KINDS[:3], KINDS[3:]
SPAN_TYPE = "array<struct<start:int,kind:int,end:int>>"
#: What each kind serves as, and which of these a weak kind must have near.
SERVES = {"assign": ("secret", "strong"), "access": ("identifier", "strong"), "hex": ("secret", "strong"),
          "account": ("identifier",), "key40": ("secret",), "endpoint": ()}
NEEDS = {"account": "secret", "key40": "identifier", "endpoint": "strong"}
BLOCK = 256


def _running(lengths: Column) -> Column:
    """Sum of all elements before each one, by blocks, so that long arrays don't cost their square."""
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    blocks = F.transform(positions(F.floor(F.size(lengths) / BLOCK).cast("int") + 1),
                         lambda b: total(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))))
    heads = bind(blocks, lambda s: F.transform(positions(F.size(s)), lambda b: total(F.slice(s, F.lit(1), b))))
    return bind(heads, lambda h: F.transform(positions(F.size(lengths)), lambda i: F.get(h, F.floor(i / BLOCK).cast("int")) + total(
        F.slice(lengths, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK))))


def spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Leftmost non-overlapping matches as (start, kind, end) in code points, end exclusive.

    The pieces between the matches and the matches themselves give the places."""
    none = F.array().cast(SPAN_TYPE)

    def placed(pieces: Column, hits: Column) -> Column:
        steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(hits)), hits, lambda p, m: F.length(p) + F.length(m))
        at = bind(steps, _running)
        every = bind(at, lambda a: F.transform(positions(F.size(hits)), lambda i: bind(
            F.get(a, i) + F.length(F.get(pieces, i)), lambda s: F.struct(
                s.alias("start"), F.lit(kind).alias("kind"), (s + F.length(F.get(hits, i))).alias("end"),
                F.get(hits, i).alias("m")))))
        good = F.filter(every, lambda x: keep(x["m"])) if keep else every
        return F.transform(good, lambda x: F.struct(x["start"], x["kind"], x["end"])).cast(SPAN_TYPE)

    found = bind(F.split(text, pattern, -1), lambda p: bind(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: placed(p, m)))
    return F.when(text.rlike(pattern), found).otherwise(none)


def _long_value(group: int):
    return lambda m: F.length(F.regexp_extract(m, ASSIGN, group)) >= LEAST_VALUE


def strong_spans(t: Column) -> Column:
    return F.array_sort(F.concat(spans(t, ASSIGN, 0, _long_value(2)), spans(t, ACCESS, 1), spans(t, HEX, 2)))


def weak_spans(t: Column) -> Column:
    return F.concat(spans(t, ACCOUNT, 3),
                    spans(t, KEY40, 4, lambda m: (F.length(m) == 40) & ~m.rlike("^[0-9a-f]+$|^[A-Z]+$|^[a-z]+$")),
                    spans(t, ENDPOINT, 5))


def listed(s: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(s, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def link(found: DataFrame, reach: int = REACH) -> DataFrame:
    """(key, linked): the weak spans of ``found`` (key, strong, weak) that have their complement within reach."""
    parts = found.where(F.size("weak") > 0)
    each = parts.select("key", F.explode(F.concat("strong", "weak")).alias("s")).select("key", "s.*")
    name = F.get(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))

    def by_kind(mapping):
        case = None
        for k, v in mapping.items():
            case = F.when(name == k, v) if case is None else case.when(name == k, v)
        return case

    serves = by_kind({k: F.array(*[F.lit(x) for x in v]) for k, v in SERVES.items() if v})
    buckets = F.sequence(F.floor(F.col("start") / reach), F.floor((F.col("end") - 1) / reach))
    held = (each.select("key", "start", "end", F.explode(serves).alias("role"), buckets.alias("bs"))
            .select("key", "role", "start", "end", F.explode("bs").alias("bucket"))
            .groupBy("key", "role", "bucket").agg(F.min("start").alias("first"), F.max("end").alias("last")))
    asks = by_kind({k: F.lit(v) for k, v in NEEDS.items()})
    lo, hi = F.col("start") - reach, F.col("end") + reach
    probes = (each.select("key", "start", "kind", "end", asks.alias("role"), lo.alias("lo"), hi.alias("hi"),
                          F.explode(F.sequence(F.floor(lo / reach), F.floor(hi / reach))).alias("bucket"))
              .where(F.col("role").isNotNull()))
    near = (probes.join(held, ["key", "role", "bucket"])
            .where((F.col("last") >= F.col("lo")) & (F.col("first") <= F.col("hi"))))
    return near.groupBy("key").agg(F.collect_set(F.struct("start", "kind", "end")).alias("linked"))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """One row per document: ``strong`` and ``linked`` spans as arrays of (start, kind, end)."""
    row = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text).alias("key"), whole(text).alias("_t"))
    found = materialize(row.select("doc_id", "key", bind(F.col("_t"), strong_spans).alias("strong"),
                                   bind(F.col("_t"), weak_spans).alias("weak")), "secret-spans")
    return (found.join(link(found, reach), "key", "left")
            .select("doc_id", "strong", F.coalesce("linked", F.array().cast(SPAN_TYPE)).alias("linked")))


def report(scanned: DataFrame) -> DataFrame:
    """Counts, digest and listing of the spans of ``scan``."""
    def count(i, k):
        return F.size(F.filter("strong", lambda x: x["kind"] == i)).cast("bigint").alias(f"n_{k}")

    return scanned.select("doc_id", *[count(i, k) for i, k in enumerate(STRONG)], digest(listed(F.col("strong"))).alias("base_sha256"),
                          listed(F.array_sort(F.concat("strong", "linked"))).alias("spans"))


def _any_case(pattern: str) -> str:
    """The pattern with each letter of its keywords in either case, without a flag."""
    head, _, tail = pattern.removeprefix("(?i)").partition(")")
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in head) + ")" + tail


def sql(reach: int = REACH) -> str:
    """The same scan in SQL, linking by comparison of all spans of a document."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    patterns = dict(zip(KINDS, (_any_case(ASSIGN), ACCESS, HEX, _any_case(ACCOUNT), KEY40, ENDPOINT)))
    found = " union all ".join(f"select doc_id, {quoted(k)} as kind, {i} as k, string_split_regex(t, {quoted(r)}) as ps, "
                               f"regexp_extract_all(t, {quoted(r)}) as hs from d where regexp_matches(t, {quoted(r)})"
                               for i, (k, r) in enumerate(patterns.items()))
    roles = " or ".join(f"(w.kind = {quoted(k)} and p.kind in ({', '.join(quoted(x) for x, has in SERVES.items() if need in has)}))"
                        for k, need in NEEDS.items())
    strong = ", ".join(map(quoted, STRONG))
    counts = ", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in STRONG)
    return rf"""
with d as (select doc_id, coalesce(text, '') as t from documents),
m as ({found}),
u as (select doc_id, kind, k, ps, hs, unnest(range(1, len(hs) + 1)) as i from m),
s as (select doc_id, kind, k, hs[i] as h, cast(list_sum(list_transform(ps[1:i], lambda x: length(x)))
  + coalesce(list_sum(list_transform(hs[1:i - 1], lambda x: length(x))), 0) as bigint) as st from u),
f as (select doc_id, kind, k, st, st + length(h) as en from s where case kind
  when 'assign' then length(regexp_extract(h, {quoted(patterns['assign'])}, 2)) >= {LEAST_VALUE}
  when 'key40' then length(h) = 40 and not regexp_matches(h, '^[0-9a-f]+$|^[A-Z]+$|^[a-z]+$') else true end),
kept as (select * from f w where kind in ({strong}) or exists (select 1 from f p where p.doc_id = w.doc_id and ({roles})
  and p.st <= w.en + {reach} and p.en >= w.st - {reach})),
g as (select doc_id, {counts}, string_agg(kind || ':' || st || ':' || en, ',' order by st, k) filter (kind in ({strong})) as base,
  string_agg(kind || ':' || st || ':' || en, ',' order by st, k, en) as spans from kept group by doc_id)
select d.doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in STRONG)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join g using (doc_id)
"""
