"""Page extraction: articles planted in pages of many layouts, odd markup, and the given pages."""
from __future__ import annotations

import html
import random
import re

import pytest

from clickgauge.llm.pagetext import extracted, main_text

from .conftest import sentence

SF = "/root/testdata/sf0.01"


def prose(rng, n):
    return " ".join(w + ("," if rng.random() < 0.1 else "") for w in sentence(rng, n)) + "."


def paragraphs(blocks, tag="p", **kw):
    attrs = "".join(f' {k.rstrip("_")}="{v}"' for k, v in kw.items())
    return "".join(f"<{tag}{attrs}>{html.escape(b)}</{tag}>\n" for b in blocks)


LAYOUTS = {
    "article": lambda t, b: f"<article><h1>{t}</h1>{paragraphs(b)}</article>",
    "unclosed": lambda t, b: f"<article><h1>{t}</h1>" + "".join(f"<p>{html.escape(x)}" for x in b) + "</article>",
    "main": lambda t, b: f"<main id=content><h1>{t}</h1><div class=body>{paragraphs(b)}</div></main>",
    "article_header": lambda t, b: f"<article class='post category-news comments-open'><header><h1>{t}</h1></header><div>{paragraphs(b)}</div></article>",
    "div": lambda t, b: f"<div id='page'><div class='content with-sidebar'><h1>{t}</h1>{paragraphs(b)}</div></div>",
    "leaf_divs": lambda t, b: f"<div class='text'><h1>{t}</h1>{paragraphs(b, 'div', class_='para')}</div>",
    "sections": lambda t, b: f"<article><h1>{t}</h1><section>{paragraphs(b[:2])}</section><section>{paragraphs(b[2:])}</section></article>",
    "table": lambda t, b: f"<table><tr><td><ul><li><a href='/'>home</a></ul></td><td><h1>{t}</h1>{paragraphs(b)}</td></tr></table>",
    "form_page": lambda t, b: f"<form action='/x'><input name=q><div id=wrap><h1>{t}</h1>{paragraphs(b)}</div></form>",
    "list_and_quote": lambda t, b: f"<article><h1>{t}</h1><ul>{paragraphs(b[:2], 'li')}</ul><blockquote>{html.escape(b[2])}</blockquote>{paragraphs(b[3:])}</article>",
    "spans": lambda t, b: f"<article><h1><span>{t}</span></h1>" + "".join(f"<p><b>{html.escape(x[:9])}</b><i>{html.escape(x[9:])}</i></p>" for x in b) + "</article>",
}


def dressed(rng, core):
    """The article among everything that is no part of it."""
    links = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in sentence(rng, 8))
    before = [f"<header><a href=/>{prose(rng, 4)}</a></header>", f"<nav><ul>{links}</ul></nav>", f'<div class="ad">{prose(rng, 40)}</div>',
              f'<div id="cookie-banner" role="dialog"><p>{prose(rng, 60)}</p></div>', f'<ul class="breadcrumbs">{links}</ul>',
              f'<form><label>Search</label><select><option>{prose(rng, 30)}</select></form>', f"<div class='menu'>{links}</div>"]
    after = [f"<aside><h2>More</h2><p>{prose(rng, 80)}</p></aside>", f'<div class="sidebar"><p>{prose(rng, 80)}</p></div>', f"<footer>&copy; {prose(rng, 12)}</footer>",
             f'<section id="comments"><h2>3 comments</h2><p>{prose(rng, 90)}</p><p>{prose(rng, 50)}</p></section>', f'<div class="newsletterSignup">{prose(rng, 40)}</div>',
             f'<div><h3>Comments (2)</h3><p>{prose(rng, 70)}</p></div>', f'<div style="display: none">{prose(rng, 99)}</div>', f"<noscript>{prose(rng, 30)}</noscript>",
             f'<div class="related">{links}</div>', f"<div hidden>{prose(rng, 50)}</div>"]
    rng.shuffle(before)
    rng.shuffle(after)
    return ('<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>T</title><style>p{margin:0}</style><script>var t="</p><article>";</script></head>'
            f"<body class='has-sidebar'>{''.join(before[:rng.randint(0, 7)])}<!-- <p>ad</p> -->{core}{''.join(after[:rng.randint(0, 10)])}</body></html>")


@pytest.mark.parametrize("name", LAYOUTS)
def test_articles_come_out_whole_and_alone(name):
    rng = random.Random(name)
    for _ in range(40):
        title = " ".join(sentence(rng, 5))
        blocks = [prose(rng, rng.choice([3, 12, 40, 150])) for _ in range(rng.randint(4, 9))]
        blocks[rng.randint(0, 3)] = prose(rng, 60)
        assert main_text(dressed(rng, LAYOUTS[name](title, blocks))).split("\n") == [title, *blocks]


@pytest.mark.parametrize(("source", "want"), [
    (None, ""), ("", ""), ("   ", ""), ("plain text only", "plain text only"), ("<p></p><nav>x</nav>", ""), ("<article></article>", ""),
    ("<article><p>a &lt;b&gt; &amp;amp; &eacute;&#233;&#x4E2D;&nbsp;c</article>", "a <b> &amp; éé中 c"),
    ("<article><p>one<br>two\n\t three<p>1 < 2 and 3 > 2</article>", "one two three\n1 < 2 and 3 > 2"),
    ("<article><p>kept<script>if (a < b) '</p>'</script> words<style>p{}</style></p><p title='a > b'>next", "kept words\nnext"),
    ("<ARTICLE><P>Upper <B>case</b></P></ARTICLE>", "Upper case"),
    ("<article><p>cut off <a href='x", "cut off"),
    ("<article><p>a</p><p class=\"it's>broken</p><p>b</p></article>", "a\nbroken\nb"),
    ("<article><p>first</p><!-- never closed <p>x</p>", "first"),
    ("<body><h1>Only a heading</h1></body>", "Only a heading"),
])
def test_odd_markup(source, want):
    assert main_text(source) == want


def test_long_and_deep_pages_end():
    deep = "<div><b><p>" * 30_000 + "x" * 200
    assert main_text(deep).endswith("x" * 200)
    assert len(main_text("<article>" + "<p>many words, here " * 50_000)) == 50_000 * 17 - 1
    assert main_text("<article><p>" + "<" * 50_000 + "</article>").startswith("<<")


def test_given_pages(spark):
    """Their article element, block by block."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = r["html"][r["html"].index("<article>") + 9:r["html"].index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", b).replace("<br>", " ")).split()) for b in re.split("</?(?:p|h1)>", inner))
        want[r["page_id"]] = "\n".join(b for b in blocks if b)
    got = {r["page_id"]: r for r in extracted(pages).collect()}
    assert {k: r["text"] for k, r in got.items()} == want and all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_rows_with_nulls_repeats_and_extra_columns(spark):
    rows = [(1, "u", "<p>a b c</p>", "x", 9), (1, "u", "<p>a b c</p>", "x", 9), (None, None, None, None, None), (2, None, "", "y", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = sorted((tuple(r) for r in extracted(pages).collect()), key=repr)
    assert got == sorted([(1, "u", "a b c", 5), (1, "u", "a b c", 5), (None, None, "", 0), (2, None, "", 0)], key=repr)
    assert extracted(pages.limit(0)).count() == 0
