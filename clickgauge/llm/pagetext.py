"""Main text of web pages by tree scoring.

A page becomes a tree of elements, with end tags implied where authors leave them out. Elements that are
never text (scripts, forms, navigation, footers and the like, by tag, role or name) are cut off. Every
paragraph earns points for its length and its commas and passes them to its ancestors, less with each
level; ``article`` and ``main`` get them whole. A container's points are discounted by the share of its
text that lies in links. The best container is kept, with those siblings that have a good share of its
points or are prose of their own; every block inside is kept, none is cut.

Character references are decoded, white space (``br`` included) is one space, blocks are joined by one
newline in page order. One page is one row of work: nothing is shuffled, batches bound the memory.

Null and empty pages, and pages without text, give an empty string. Markup that is cut off, unclosed,
stray or deeply nested is read as browsers do as far as text goes. Repeated rows give equal rows, one row
out for each row in. Null ids and urls stay. Ties go to the outermost, first container. An empty table
gives an empty result. Columns besides id, url and html are ignored.
"""
from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

# HTML's own element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th "
                  "thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body caption dd dt head html legend li optgroup option summary tbody td tfoot th thead tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("article body center div main section td".split())
PROSE = frozenset("p pre blockquote ul ol dl table figure".split())
# A start tag ends an open element of these, up to the nearest element of the others.
ENDS = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
        "th": ("td th", "tr table"), "tbody": ("tbody thead tfoot tr td th", "table"), "option": ("option", "select")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}

# Elements, roles and name words that mark what is no text of the article.
NO_TEXT = frozenset("applet aside audio button canvas datalist dialog embed fieldset footer head iframe input label legend menu nav noembed "
                    "noframes noscript object script select style svg template textarea title video xmp".split())
NO_ROLE = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
UNWANTED = frozenset("ad ads adsense advert adverts advertisement advertising adbox adslot banner comment comments commentlist consent cookie cookies "
                     "disclaimer discussion disqus gdpr login modal newsletter notice notification outbrain paywall popup promo promoted promotion "
                     "replies reply respond signup skip sponsor sponsored subscribe subscription taboola".split())
LAYOUT = frozenset("breadcrumb breadcrumbs foot footer header masthead menu nav navbar navigation pager pagination recommended related rail share sharing "
                   "sidebar sidenav social toolbar topbar widget".split())
NO_NAME = frozenset("category closed disabled enabled format has hide lang language no open status tag type with without".split())  # names of states
COMMENTS = re.compile(r"(\d+ )?(reader )?(comments?|replies|responses|kommentare?|leserkommentare|commentaires?|comentarios?)( \(?\d+\)?)?:?", re.I)

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>|</[^>]*>|<(?=/?[a-zA-Z])[^<]*\Z", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")

LEVELS = 5            # containers above a paragraph that its points reach
LINK_DENSITY = 0.25   # of prose; more is a list of links
SIBLING = 0.2         # share of the best container's points
PROSE_LENGTH = 80


def name_words(attributes: str) -> tuple[set[str], bool, str]:
    """Words of class and id, whether the element is hidden, and its role."""
    found = {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(attributes)}
    names = [{w.lower() for w in CAMEL.split(x) if w} for x in f"{found.get('class', '')} {found.get('id', '')}".split()]
    words = set().union(*[n for n in names if not n & NO_NAME])
    style = found.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style
    return words, hidden, found.get("role", "").lower()


class Page:
    """Elements by number in page order: tag, parent, whether cut off; and blocks (element, text, characters in links)."""

    def __init__(self, source: str):
        self.tags, self.parents, self.cut = ["#page"], [0], [False]
        self.spare: list[int] = []  # cut off by a layout word; kept if the article itself lies within
        self.blocks: list[tuple[int, str, int]] = []
        self._stack, self._open = [0], Counter()
        self._text: list[str] = []
        self._linked = 0
        self._read(source)
        self._flush()
        self._rescue()

    # -- reading

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            m = TOKEN.search(source, at)
            if not m:
                self._add(source[at:])
                return
            if m.start() > at:
                self._add(source[at:m.start()])
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
                continue
            self._start(tag, m[3])
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                at = close.start() if close else size
                if not close:
                    self._end(tag)

    def _add(self, text: str) -> None:
        if self.cut[self._stack[-1]]:
            return
        text = entities.unescape(text)
        self._text.append(text)
        if self._open["a"]:
            self._linked += len(text)

    def _flush(self) -> None:
        """Ends the block under way."""
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.blocks.append((self._owner(), text, min(self._linked, len(text))))
            self._text, self._linked = [], 0

    def _owner(self) -> int:
        for i in reversed(self._stack):
            if self.tags[i] in BLOCK or not i:
                return i
        return 0

    def _pop(self, names: frozenset, barriers: frozenset) -> None:
        """Closes the nearest open element of ``names`` unless a barrier is nearer."""
        if not any(self._open[n] for n in names):
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[depth]]
            if tag in names:
                if any(self.tags[i] in BLOCK for i in self._stack[depth:]):
                    self._flush()
                while len(self._stack) > depth:
                    self._open[self.tags[self._stack.pop()]] -= 1
                return
            if tag in barriers:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag == "hr" or tag == "img":
            self._add(" ")
        if tag in CLOSES_P:
            self._pop(frozenset("p"), CONTAINERS | {"td", "th", "li", "table"})
        if tag in ENDS:
            self._pop(*ENDS[tag])
        if tag == "body":
            self._pop(frozenset(("head",)), frozenset())
        if tag == "a":
            if "href" not in attributes.lower():
                return
            self._pop(frozenset("a"), BLOCK - {"p"})
        if tag in BLOCK:
            self._flush()
        if tag in VOID:
            return
        parent = self._stack[-1]
        cut = self.cut[parent] or self._no_text(tag, attributes)
        self.tags.append(tag)
        self.parents.append(parent)
        self.cut.append(cut)
        self._stack.append(len(self.tags) - 1)
        self._open[tag] += 1

    def _end(self, tag: str) -> None:
        if tag not in VOID:
            self._pop(frozenset((tag,)), frozenset() if tag in BLOCK or tag in RAW else CONTAINERS)

    # -- what is no text

    def _no_text(self, tag: str, attributes: str) -> bool:
        if tag in NO_TEXT or tag == "header" and not self._open["article"] and not self._open["main"]:
            return True
        if tag == "form":
            self.spare.append(len(self.tags))
        if not attributes or tag in ("html", "body"):
            return False
        words, hidden, role = name_words(attributes)
        if hidden or role in NO_ROLE or words & UNWANTED and tag not in HEADINGS:
            return True
        if words & LAYOUT and tag not in ("main", "article") and tag not in HEADINGS:
            self.spare.append(len(self.tags))
        return False

    def _rescue(self) -> None:
        """Cuts forms, elements with layout names and those headed as comments, unless an article, a main element
        or a first heading lies within."""
        self.spare += [self.parents[at] for at, text, _ in self.blocks if self.tags[at] in HEADINGS and COMMENTS.fullmatch(text)
                       and self.tags[self.parents[at]] not in ("article", "main", "body", "#page")]
        if not self.spare:
            return
        holds = [tag in ("article", "main", "h1") and not cut for tag, cut in zip(self.tags, self.cut)]
        for i in range(len(holds) - 1, 0, -1):
            if holds[i]:
                holds[self.parents[i]] = True
        for i in self.spare:
            self.cut[i] = self.cut[i] or not holds[i]
        for i in range(1, len(self.cut)):
            self.cut[i] = self.cut[i] or self.cut[self.parents[i]]
        self.blocks = [b for b in self.blocks if not self.cut[b[0]]]

    # -- scoring

    def points(self) -> tuple[list[float], list[float]]:
        """(points, link density) of every element."""
        n = len(self.tags)
        points, size, linked = [0.0] * n, [0] * n, [0] * n
        leaf = [tag in CONTAINERS - {"body"} for tag in self.tags]  # a container of inline text alone is a paragraph
        for i in range(1, n):
            if self.tags[i] in BLOCK:
                leaf[self.parents[i]] = False
        outer = [0] * n  # nearest article above or at, else nearest main
        for i in range(1, n):
            above = outer[self.parents[i]]
            outer[i] = i if self.tags[i] == "article" or self.tags[i] == "main" and self.tags[above] != "article" else above
        for at, text, links in self.blocks:
            size[at] += len(text)
            linked[at] += links
            if self.tags[at] in HEADINGS:
                continue
            earned = (min(len(text) / 25, 1.0) + text.count(",") + text.count("，") + min(len(text) / 100, 3.0)) * (1 - links / len(text))
            i = self.parents[at] if leaf[at] and self.parents[at] else at
            whole, level = outer[i], 0
            if whole:
                points[whole] += earned
            while i and level < LEVELS:
                if self.tags[i] in CONTAINERS:
                    if i != whole:
                        points[i] += earned / (1, 2, 6, 9, 12)[level]
                    level += 1
                i = self.parents[i]
        for i in range(n - 1, 0, -1):
            size[self.parents[i]] += size[i]
            linked[self.parents[i]] += linked[i]
        density = [k / s if s else 0.0 for k, s in zip(linked, size)]
        self.size = size
        return [p * (1 - d) for p, d in zip(points, density)], density

    def text(self) -> str:
        """The blocks of the best container and of the siblings kept with it."""
        if not self.blocks:
            return ""
        points, density = self.points()
        best = max(range(len(points)), key=lambda i: (points[i], -i))
        if points[best] <= 0:  # headings or links alone
            best = 0
        kept = [False] * len(points)
        kept[best] = True
        if best:
            holder = self.parents[best]
            for i in range(1, len(points)):
                if self.parents[i] == holder and i != best and self.size[i]:
                    tag, prose = self.tags[i], density[i] <= LINK_DENSITY
                    kept[i] = (tag in CONTAINERS and prose and points[i] >= SIBLING * points[best] or tag in HEADINGS and prose
                               or tag in PROSE and prose and self.size[i] >= PROSE_LENGTH)
        for i in range(1, len(points)):
            kept[i] = kept[i] or kept[self.parents[i]]
        return "\n".join(text for at, text, _ in self.blocks if kept[at])


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extracted(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars per page."""
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url)]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    given = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))
    return map_arrow(given, of, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
