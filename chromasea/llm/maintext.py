"""Main text of web pages from parser events: text-to-tag ratios, smoothed and cut at a threshold.

The standard library's parser reads a page once. Its events become lines, one for each stretch of
text between block boundaries, with the number of tags met on the way. The ratio of a line is its
characters by its tags; text in places that never belong to an article (menus, forms, adverts, ...)
counts nothing. Ratios are smoothed by a Gaussian along the page, and lines at or above their standard
deviation are content. The content lines choose the region (the article, the main part, or the smallest
element that holds nearly all of them), and the region gives its whole text, short lines too.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Element and class names of HTML, by what they hold.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter picture q ruby rb rp rt rtc s samp small "
    "source span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset(
    "head title script style noscript template nav header footer aside form button select option textarea iframe object svg math canvas audio "
    "video map menu dialog datalist".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager footer sidebar sidebars rail widget widgets "
    "cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay paywall newsletter subscribe subscription signup login "
    "comment comments commentlist disqus respond replies share sharing social related recommended".split()
)
HEADER_NAMES = frozenset("header masthead".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())
NAME = re.compile(r"[A-Za-z][a-z0-9]*|[0-9]+")

SIGMA, RADIUS = 1.0, 3
MOST = 0.8


class _Element:
    __slots__ = ("tag", "parent", "outside", "article", "closed", "number", "chars", "in_header")

    def __init__(self, tag, parent, place, number):
        self.tag, self.parent, self.number = tag, parent, number
        self.closed, self.chars = False, 0
        above = parent is not None and parent.article
        self.article = above or tag in ("article", "main")
        # The heading of an article may stand in a header of its own, so such a header is not left out as a whole.
        self.outside = place == "outside" or (place == "header" and not above)
        self.in_header = (place == "header" and above) or bool(parent and parent.in_header)


class Lines(HTMLParser):
    """Events of one page to lines: (text, tags, element, whether a heading)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Element("", None, "", 0)
        self.elements, self.stack, self.open = [self.root], [self.root], {}
        self.lines, self.words, self.tags, self.heading = [], [], 0, 0

    def end_line(self):
        text = " ".join("".join(self.words).split())
        if text:
            self.lines.append((text, max(self.tags, 1), self.stack[-1], self.heading > 0))
            self.tags = 0
        self.words = []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.words.append(" ")
            self.tags += 1
            return
        place = _place(tag, attrs)
        if tag in INLINE and not place and not self.open.get(tag):
            self.tags += 1
            return
        self.end_line()
        self.tags += 1
        if tag in HEADINGS:
            self.heading += 1
        if tag not in INLINE and self.stack[-1].tag in CLOSES_ITSELF and (tag == self.stack[-1].tag or self.stack[-1].tag == "p"):
            self.open[self.stack[-1].tag] -= 1
            self.stack.pop().closed = True
        if tag not in VOID:
            inner = _Element(tag, self.stack[-1], place, len(self.elements))
            self.elements.append(inner)
            self.stack.append(inner)
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1].tag == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in HEADINGS and self.heading:
            self.end_line()
            self.heading -= 1
        if not self.open.get(tag):
            if tag not in INLINE and tag != "br":
                self.end_line()
            return
        self.end_line()
        while True:
            top = self.stack.pop()
            self.open[top.tag] -= 1
            if top.tag == tag:
                top.closed = True
                return

    def handle_data(self, data):
        self.words.append(data)


def _place(tag: str, attrs) -> str:
    """"outside", "header" or "", by the name, classes, id and role of an element."""
    if tag == "header" or tag in OUTSIDE:
        return "header" if tag == "header" else "outside"
    if tag in ("html", "body", "main"):
        return ""
    if tag == "article":
        classes = {n for k, v in attrs if k == "class" and v for n in v.lower().split()}
        return "outside" if classes & {"comment", "advert", "ad", "sponsored"} else ""
    for key, value in attrs:
        # The id of a heading is an anchor and says nothing about its place.
        if value and (key == "class" or (key == "id" and tag not in HEADINGS)):
            names = {n.lower() for n in NAME.findall(value)}
            if names & OUTSIDE_NAMES:
                return "outside"
            if names & HEADER_NAMES:
                return "header"
        if value and key == "role" and value.strip().lower() in ROLES:
            return "outside"
    return ""


def _places(elements: list[_Element], only_closed: bool) -> list[bool]:
    """Whether each element lies outside any article; parents come before their children."""
    out: list[bool] = []
    for e in elements:
        own = e.outside and (e.closed or not only_closed)
        out.append(own or (e.parent is not None and out[e.parent.number]))
    return out


def smoothed(ratios: np.ndarray, sigma: float = SIGMA, radius: int = RADIUS) -> np.ndarray:
    """Gaussian means along the lines; at the ends the weights of what is there add up to one."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    n = len(ratios)
    full = slice(radius, radius + n)
    return np.convolve(ratios, kernel)[full] / np.convolve(np.ones(n), kernel)[full]


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """Threshold clustering: smoothed ratios at or above their standard deviation. The largest always is."""
    values = smoothed(ratios)
    return (values >= values.std()) & (ratios > 0)


def main_text(html: str | None) -> str:
    """The main text of one page; empty for a null or empty page and for one without text of its own."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.close()
    page.end_line()
    for only_closed in (False, True):
        # A menu that is never closed would swallow the page: then only closed elements count as such.
        kept = _region(page, _places(page.elements, only_closed))
        if kept:
            return " ".join(kept)
    return ""


def _region(page: Lines, outside: list[bool]) -> list[str]:
    def counts(line) -> bool:
        _, _, e, heading = line
        return not outside[e.number] and (heading or not e.in_header)

    if not any(map(counts, page.lines)):
        return []
    content = content_lines(np.array([len(line[0]) / line[1] if counts(line) else 0.0 for line in page.lines]))
    for e in page.elements:
        e.chars = 0
    for line, is_content in zip(page.lines, content):
        if is_content and counts(line):
            line[2].chars += len(line[0])
    for e in reversed(page.elements[1:]):
        e.parent.chars += e.chars
    articles = _outermost(page.elements, outside, "article") or _outermost(page.elements, outside, "main")
    if articles:
        inside = [False] * len(page.elements)
        for e in page.elements:
            inside[e.number] = e.number in articles or (e.parent is not None and inside[e.parent.number])
        return [line[0] for line in page.lines if inside[line[2].number] and counts(line)]
    region = page.root
    for e in page.elements[1:]:
        # Parents come first, so each step goes one element deeper while it still holds nearly all.
        if e.parent is region and e.tag not in CLOSES_ITSELF and e.chars >= MOST * page.root.chars and not outside[e.number]:
            region = e
    inside = [False] * len(page.elements)
    for e in page.elements:
        inside[e.number] = e is region or (e.parent is not None and inside[e.parent.number])
    at = [i for i, c in enumerate(content) if c and inside[page.lines[i][2].number]]
    return [line[0] for line in page.lines[at[0]:at[-1] + 1] if inside[line[2].number] and counts(line)]


def _outermost(elements: list[_Element], outside: list[bool], tag: str) -> set[int]:
    """Numbers of the outermost elements of a name that hold content lines."""
    within = [False] * len(elements)
    found = set()
    for e in elements:
        above = e.parent is not None and within[e.parent.number]
        within[e.number] = above or e.tag == tag
        if e.tag == tag and not above and not outside[e.number] and e.chars:
            found.add(e.number)
    return found


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of pages (page_id, url, html).

    A null page is an empty one, with an empty text. Null ids and urls stay null, repeated rows
    stay repeated, other columns are left out. Each page is read by itself in its own task: no shuffle.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"),
                "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            })

    kinds = dict(pages.select("page_id", "url").dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
