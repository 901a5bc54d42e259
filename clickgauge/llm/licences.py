"""Licence scan by recognised sentences.

A text is cut into sentences at full stops, blank lines and list items; a wrapped line goes on with its
sentence, without the comment mark before it, and so does a clause after a semicolon. Sentences that speak
of licensing are normalised and mapped to identifiers of known licence sentences, SPDX lines included. The identifiers of a document, in order, are then matched against ordered
licence rules, longest rule first, leftmost and without overlap. Everything happens within the row, so
nothing is shuffled.

Null and empty texts have no sentences and no licence. Repeated rows get the same answer, one row out
for each row in. An empty table gives an empty result. Columns besides ``id`` and ``text`` are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bind
from .common import ascii_lower, whole

# SPDX identifiers, those that begin like others first, and their normalised forms.
SPDX = tuple((name, name.lower().replace("-", " ")) for name in (
    "Apache-2.0", "BSD-3-Clause", "BSD-2-Clause", "MIT", "ISC", "AGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0", "GPL-3.0-or-later", "GPL-3.0-only",
    "GPL-3.0", "GPL-2.0-or-later", "GPL-2.0-only", "GPL-2.0", "LGPL-3.0-or-later", "LGPL-3.0-only", "LGPL-3.0", "LGPL-2.1-or-later", "LGPL-2.1-only",
    "LGPL-2.1", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "Unlicense"))
# Known sentences as patterns over normalised text, first match wins.
SENTENCES = {
    **{f"spdx{i}": f"spdx license identifier:? {p}( |$)" for i, (_, p) in enumerate(SPDX)},
    "gpl3later": "gnu general public licen[sc]e.* version 3.* or (at your option )?any later version",
    "gpl2later": "gnu general public licen[sc]e.* version 2.* or (at your option )?any later version",
    "lgpl3": "gnu lesser general public licen[sc]e.* (version|v) ?3",
    "lgpl21": "gnu lesser general public licen[sc]e.* (version|v) ?2.1",
    "agpl3": "gnu affero general public licen[sc]e",
    "gpl3": "gnu general public licen[sc]e,? (version|v) ?3|licen[sc]ed under (the )?gplv?3",
    "gpl2": "gnu general public licen[sc]e,? (version|v) ?2|licen[sc]ed under (the )?gplv?2",
    "gplany": "gnu general public licen[sc]e",
    "apache2": "apache licen[sc]e,? version 2|apache licen[sc]e 2|licen[sc]ed under apache 2",
    "apachecopy": "you may obtain a copy of the licen[sc]e at",
    "apacheasis": "distributed under the licen[sc]e is distributed on an as is basis",
    "apachesee": "see the licen[sc]e for the specific language governing permissions",
    "mitgrant": "permission is hereby granted free of charge to any person obtaining a copy",
    "mitnotice": "the above copyright notice and this permission notice shall be included",
    "mitasis": "the software is provided as is without warranty of any kind",
    "mitname": "under (the )?mit licen[sc]e",
    "bsdgrant": "redistribution and use in source and binary forms with or without modification are permitted",
    "bsdsource": "redistributions of source code must retain the above copyright notice",
    "bsdbinary": "redistributions in binary form must reproduce the above copyright notice",
    "bsdendorse": "neither the name of .* may be used to endorse or promote",
    "bsdname": "under (the|a) (new |modified |simplified |3 clause |2 clause )?bsd ?(style )?licen[sc]e",
    "iscgrant": "permission to use copy modify and or distribute this software for any purpose with or without fee",
    "iscasis": "the software is provided as is and .*disclaims all warranties",
    "mpl2": "mozilla public licen[sc]e,? (version|v)? ?2",
    "ccbyncnd": "cc by nc nd [0-9.]+|creative commons attribution noncommercial noderiv",
    "ccbyncsa": "cc by nc sa [0-9.]+|creative commons attribution noncommercial sharealike",
    "ccbync": "cc by nc [0-9.]+|creative commons attribution noncommercial",
    "ccbysa": "cc by sa [0-9.]+|creative commons attribution sharealike",
    "ccbynd": "cc by nd [0-9.]+|creative commons attribution noderiv",
    "ccby": "cc by [0-9.]+|creative commons attribution",
    "cc0": "cc0|creative commons zero",
    "public": "released into the public domain|dedicated to the public domain",
    "rights": "all rights reserved",
    "copyright": "^(copyright|c) .*[0-9]{4}",
}
# Ordered rules, (licence, identifiers in order).
RULES = (
    ("Apache-2.0", ("apache2", "apachecopy", "apacheasis", "apachesee")),
    ("BSD-3-Clause", ("bsdgrant", "bsdsource", "bsdbinary", "bsdendorse")),
    ("BSD-2-Clause", ("bsdgrant", "bsdsource", "bsdbinary")),
    ("MIT", ("mitgrant", "mitnotice", "mitasis")),
    ("ISC", ("iscgrant", "iscasis")),
    ("ISC", ("iscgrant", "mitasis")),
    ("MIT", ("mitgrant", "mitnotice")),
    ("Apache-2.0", ("apache2", "apachecopy")),
    ("GPL-3.0-or-later", ("gpl3later",)),
    ("GPL-2.0-or-later", ("gpl2later",)),
    ("LGPL-3.0", ("lgpl3",)),
    ("LGPL-2.1", ("lgpl21",)),
    ("AGPL-3.0", ("agpl3",)),
    ("GPL-3.0", ("gpl3",)),
    ("GPL-2.0", ("gpl2",)),
    ("GPL", ("gplany",)),
    ("Apache-2.0", ("apache2",)),
    ("MIT", ("mitname",)),
    ("BSD", ("bsdname",)),
    ("MPL-2.0", ("mpl2",)),
    ("CC-BY-NC-ND", ("ccbyncnd",)),
    ("CC-BY-NC-SA", ("ccbyncsa",)),
    ("CC-BY-NC", ("ccbync",)),
    ("CC-BY-SA", ("ccbysa",)),
    ("CC-BY-ND", ("ccbynd",)),
    ("CC-BY", ("ccby",)),
    ("CC0-1.0", ("cc0",)),
    ("Public-Domain", ("public",)),
    ("ISC", ("iscgrant",)),
    *((name, (f"spdx{i}",)) for i, (name, _) in enumerate(SPDX)),
)
HINT = "[Ll][Ii][Cc][Ee][Nn]|[Cc][Oo][Pp][Yy][Rr]|[Pp][Ee][Rr][Mm][Ii][Ss]|[Ww][Aa][Rr][Rr][Aa]|[Rr][Ee][Dd][Ii][Ss]|[Cc][Cc] [Bb][Yy]|[Cc][Cc]0|[Pp][Uu][Bb][Ll][Ii][Cc] [Dd]|[Rr][Ii][Gg][Hh][Tt][Ss] [Rr]|[Aa][Ss] [Ii][Ss]|[Cc][Rr][Ee][Aa][Tt][Ii][Vv][Ee]|[Nn][Ee][Ii][Tt][Hh][Ee][Rr]"
# Comment marks at the start of a line; lines that begin something new; "v. 2" is no end of a sentence.
UNWRAP = (("(^|\\n)[ \\t]*(?:/\\*+|\\*+/|//+|[*#;]+|--+|<!--|\"\"\"|dnl |REM )[ \\t]*", "{1}"), ("\\n[ \\t]*(Copyright|SPDX-|All rights)", "\\n\\n{1}"),
          ("(SPDX-License-Identifier:[^\\n]*)\\n", "{1}\\n\\n"), ("([ \\n][vV])[.] ?([0-9])", "{1} {2}"))
SENTENCE_END = "[.!?]+[ \\t\\r\\n]|\\n[ \\t\\r]*\\n|\\n[ \\t]*(?:-|[0-9]+[.)]|[(][0-9a-z][)])[ \\t]"


def normalised(sentence: Column) -> Column:
    """Lower-case ASCII, all but letters, digits, dots and commas as single spaces, no dots at the ends."""
    plain = F.regexp_replace(ascii_lower(sentence), "[^a-z0-9.,]+", " ")
    return F.btrim(plain, F.lit(" .,"))


def unwrapped(text: Column) -> Column:
    """The text without comment marks; what begins a paragraph of its own stands apart."""
    for pattern, by in UNWRAP:
        text = F.regexp_replace(text, pattern, by.replace("\\n", "\n").format(None, "$1", "$2"))
    return text


def sentence_id(sentence: Column) -> Column:
    case = None
    for name, pattern in SENTENCES.items():
        case = F.when(sentence.rlike(pattern), name) if case is None else case.when(sentence.rlike(pattern), name)
    return case


def identifiers(text: Column) -> Column:
    """(place among the sentences, identifier) of each known sentence, in order."""
    numbered = F.transform(F.split(unwrapped(text), SENTENCE_END), lambda s, i: F.struct(i.alias("sentence"), s.alias("s")))
    likely = F.filter(numbered, lambda x: x["s"].rlike(HINT))
    named = F.transform(likely, lambda x: F.struct(
        x["sentence"].alias("sentence"), sentence_id(F.regexp_replace(normalised(x["s"]), ",", "")).alias("id")))
    known = F.filter(named, lambda x: x["id"].isNotNull())
    return F.when(text.rlike(HINT), known).otherwise(F.array().cast("array<struct<sentence:int,id:string>>"))


def _token(ids) -> str:
    return "".join(f"<{i}>" for i in ids)


def match_rules(sequence: Column) -> Column:
    """Licences of an identifier sequence such as ``<mitgrant><mitnotice>``, in order of place."""
    longest_first = sorted(RULES, key=lambda r: -len(r[1]))
    pattern = "|".join(_token(ids) for _, ids in longest_first)
    named = F.create_map(*[F.lit(x) for name, ids in longest_first for x in (_token(ids), name)])
    return F.transform(F.regexp_extract_all(sequence, F.lit(pattern), F.lit(0)), lambda m: F.element_at(named, m))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the known sentences and the matched licences, both in order."""
    row = docs.select(F.col(id_col).alias("doc_id"), whole(text).alias("_t"))
    known = row.select("doc_id", bind(F.col("_t"), identifiers).alias("sentences"))
    joined = F.array_join(F.transform("sentences", lambda x: F.concat(F.lit("<"), x["id"], F.lit(">"))), "")
    return known.select("doc_id", "sentences", match_rules(joined).alias("licences"))


def report(scanned: DataFrame) -> DataFrame:
    names = F.array_sort(F.array_distinct("licences"))
    return scanned.select("doc_id", F.size("sentences").cast("bigint").alias("n_sentences"),
                          F.array_join(F.transform("sentences", lambda x: F.concat_ws(":", x["sentence"], x["id"])), ",").alias("sentences"),
                          F.size("licences").cast("bigint").alias("n_matches"), F.array_join(names, ",").alias("licences"))


def sql() -> str:
    """The same scan in SQL, from the same tables."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    named = " ".join(f"when regexp_matches(x.s, {quoted(p)}) then {quoted(n)}" for n, p in SENTENCES.items())
    longest_first = sorted(RULES, key=lambda r: -len(r[1]))
    rules = " ".join(f"when {quoted(_token(ids))} then {quoted(n)}" for n, ids in longest_first)
    pattern = quoted("|".join(_token(ids) for _, ids in longest_first))
    text = "coalesce(text, '')"
    for p, by in UNWRAP:
        chosen = quoted(by.format(None, "\\1", "\\2")).replace("\\n", "' || chr(10) || '")
        text = f"regexp_replace({text}, {quoted(p)}, {chosen}, 'g')"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
with d as (select doc_id, string_split_regex({text}, {quoted(SENTENCE_END)}) as ss from documents),
l as (select doc_id, list_filter(list_transform(ss, lambda x, i: {{'i': i - 1, 's': x}}), lambda x: regexp_matches(x.s, {quoted(HINT)})) as c from d),
n as (select doc_id, list_transform(c, lambda x: {{'i': x.i, 's': replace(trim(regexp_replace(translate(x.s, '{upper}', '{lower}'),
  '[^a-z0-9.,]+', ' ', 'g'), ' .,'), ',', '')}}) as c from l),
k as (select doc_id, list_filter(list_transform(c, lambda x: {{'i': x.i, 'id': case {named} end}}), lambda x: x.id is not null) as c from n),
m as (select doc_id, c, list_transform(regexp_extract_all(coalesce(array_to_string(list_transform(c, lambda x: '<' || x.id || '>'), ''), ''),
  {pattern}), lambda x: case x {rules} end) as ls from k)
select doc_id, len(c) as n_sentences, coalesce(array_to_string(list_transform(c, lambda x: x.i || ':' || x.id), ','), '') as sentences,
  len(ls) as n_matches, coalesce(array_to_string(list_sort(list_distinct(ls)), ','), '') as licences
from m
"""
