"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. What stands in menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments leaves only a cut between two lines, and an advert not even that. A line weighs as many
characters as it has, but nothing if most of them are links (whole sentences apart), and a quarter outside a page's
marked article. On a page without a mark whose text is nearly all in paragraphs, headings, items and cells, text that
stands loose in other blocks (a slogan, an imprint) weighs nothing. Weights are summed over sliding windows of lines. Text dives where windows fall to nothing, which takes
WINDOW lines without weight; it surges where a window reaches SURGE. On every page, what lies between two dives is kept
from its first surge to its last: cuts divide it into pieces, and the pieces from the first that surges to the last that
surges stay, short lines between them included. A mark (`article`, `main`) adds weight: SURGE for the text that it
begins or ends, and cuts inside it divide nothing. If nothing in a mark surges, all of it between the dives stays, and
an article of nothing but links stays whole; if nothing on an unmarked page surges, all its text stays.

Junk elements end with their closing tag or with the element around them; one that is never closed also ends at the next
sectioning element. A marked article ends a junk element of a layout name that holds it, but not a sidebar, a form or
reader comments; an article named as a comment or an advert is junk itself. Quotes that are never closed, and quotes
inside bare attribute values, don't hide text.

Character references are decoded after the markup is gone; white space inside a block becomes one space. Null,
empty and text-free pages give the empty text. Unclosed and truncated markup is allowed. Repeated rows are
extracted each by itself. An empty table gives an empty result. There are no ties. Other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, SURGE, LINK_SHARE = 3, 80, 0.6
#: The weight of a character outside the article on a page that marks one.
OUTSIDE = 0.25

_ATTRIBUTES = r"(?:=\s*\"[^\"]*\"(?=[\s/>]|\Z)|=\s*'[^']*'(?=[\s/>]|\Z)|[^>])*"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|noscript|template|svg|iframe|textarea|select|button|title|object|canvas|math)\b{_ATTRIBUTES}>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRIBUTES})(?:>|\Z)", re.DOTALL | re.IGNORECASE)
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
_JUNK = frozenset("nav header footer aside form dialog menu head".split())
_VOID = frozenset("br hr img input meta link source track col embed area base wbr param".split())
_MARKS = frozenset(("article", "main"))
_SECTIONS = frozenset("article main section nav aside header footer".split())


def _names(words: str) -> re.Pattern:
    return re.compile(rf"(?:class|id|role)\s*=\s*[\"']?[^\"'>]*(?<![a-z])(?:{words})(?![a-z])", re.IGNORECASE)


_COMMENT_NAMES = _names(r"comments?|comment-\w+|disqus|reply|replies|respond")
_ADVERT_NAMES = _names(r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|notices?|cookies?|consent|gdpr|newsletter|subscribe")
_LAYOUT_NAMES = _names(r"banner|sidebar|side-bar|alert|popup|modal|menu|navbar|nav|navigation|breadcrumbs?|footer|header|masthead|share|sharing|social|related|recommend\w*|pagination|pager|widget|toolbar|search|login|signup|complementary|contentinfo")
_HOLDERS = frozenset("div section ul ol p aside table span dl figure article".split())
#: Paragraphs and articles are content by their kind, whatever layout name they bear.
_CONTENT = frozenset(("p", "span", "article"))
_BODY = re.compile(r"[^\s]+")


#: Elements whose text is a paragraph, a heading, an item or a cell; text in other blocks is loose.
_FIRM = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption caption summary article main".split())
#: On a page whose firm text is this many times its loose text, loose text weighs nothing.
FIRM_TIMES = 3


class Line(NamedTuple):
    text: str
    linked: int  # characters in links
    inside: bool  # of a marked article
    cut: bool  # junk other than an advert stands before it
    loose: bool = False  # not in a paragraph, a heading, an item or a cell


def _junk(name: str, attributes: str) -> str:
    """Whether an element is junk: an 'advert', 'hard' where no article inside it is content, 'soft' where one may be, or ''."""
    if name in _JUNK:
        return "soft" if name in ("header", "head") else "hard"
    if name not in _HOLDERS or "=" not in attributes:
        return ""
    if _COMMENT_NAMES.search(attributes):
        return "hard"
    if _ADVERT_NAMES.search(attributes):
        return "advert"
    return "soft" if name not in _CONTENT and _LAYOUT_NAMES.search(attributes) else ""


def _never_closed(tokens: list[re.Match]) -> set[int]:
    """The places of the opening tags of possible junk that no closing tag belongs to."""
    open_: dict[str, list[int]] = {}
    for m in tokens:
        name = (m[3] or "").lower()
        if name in _JUNK or name in _HOLDERS:
            if not m[2]:
                open_.setdefault(name, []).append(m.start())
            elif open_.get(name):
                open_[name].pop()
    return {at for places in open_.values() for at in places}


def lines_of(page: str) -> list[Line]:
    """The lines of a page without its junk."""
    out: list[Line] = []
    parts: list[str] = []
    linked, in_link, article, cut = 0, 0, 0, False
    tokens = list(_TOKEN.finditer(page))
    unclosed = _never_closed(tokens)
    open_: list[tuple[str, bool]] = []  # the elements around this place, and whether each marks an article
    n_open: Counter[str] = Counter()
    junk: tuple[int, str, bool] | None = None  # of the outermost junk: its place in open_, its kind, never closed

    def end_line() -> None:
        nonlocal linked, cut
        text = " ".join(_BODY.findall(html.unescape("".join(parts)))) if parts else ""
        if text:
            out.append(Line(text, linked, article > 0, cut, next((x for x, _ in reversed(open_) if x != "span"), "") not in _FIRM))
            cut = False
        parts.clear()
        linked = 0

    def put(text: str) -> None:
        nonlocal linked
        if junk is None and text:
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    def close(depth: int) -> None:
        """Ends the elements from a place on."""
        nonlocal article, junk
        article -= sum(mark for _, mark in open_[depth:])
        n_open.subtract(x for x, _ in open_[depth:])
        del open_[depth:]
        if junk and junk[0] >= depth:
            junk = None

    at = 0
    for m in tokens:
        put(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            if m[1] and m[1].lower() not in ("svg", "button", "math"):
                end_line()
            continue
        closing = bool(m[2])
        if name in _INLINE:
            if name == "a":
                in_link = 0 if closing else 1
            elif name == "span" and closing and open_ and open_[-1][0] == "span":
                close(len(open_) - 1)
            elif name == "span" and not closing:
                if not junk and (kind := _junk(name, m[4])):
                    junk, cut = (len(open_), kind, m.start() in unclosed), cut or kind != "advert"
                open_.append((name, False))
                n_open[name] += 1
            continue
        end_line()
        in_link = 0
        if name in _VOID or m[4].endswith("/"):
            continue
        if closing:
            if n_open[name]:
                close(next(k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == name))
            continue
        while open_ and open_[-1][0] in ("p", "span") or name == "li" and open_ and open_[-1][0] == "li":
            close(len(open_) - 1)  # no block is inside a paragraph
        kind = _junk(name, m[4])
        if junk and (junk[2] and name in _SECTIONS or junk[1] == "soft" and name in _MARKS and not kind):
            junk = None
        if kind and not junk:
            junk, cut = (len(open_), kind, m.start() in unclosed), cut or kind != "advert"
        mark = name in _MARKS and not junk
        article += mark
        open_.append((name, mark))
        n_open[name] += 1
    put(page[at:])
    end_line()
    return out


def weights(lines: list[Line]) -> list[float]:
    """Characters that are no links; a quarter of them outside a marked article, none of loose text where nearly all text is firm."""
    marked = any(x.inside for x in lines)
    size = [0 if x.linked > LINK_SHARE * len(x.text) and not (len(x.text) >= SURGE and x.text.endswith((".", "!", "?"))) else len(x.text) for x in lines]
    if marked:
        return [n if x.inside else n * OUTSIDE for x, n in zip(lines, size, strict=True)]
    loose = sum(n for x, n in zip(lines, size, strict=True) if x.loose)
    return [0 if x.loose else n for x, n in zip(lines, size, strict=True)] if sum(size) - loose >= FIRM_TIMES * loose else size


def _between(size: list[float], lo: int, hi: int) -> list[tuple[int, int]]:
    """The stretches of lines lo to hi between dives: runs of at least WINDOW lines without weight, whose windows hold nothing."""
    out, start, i = [], lo, lo
    while i < hi:
        j = i
        while j < hi and not size[j]:
            j += 1
        if j - i >= WINDOW:
            out.append((start, i))
            start = j
        i = j + 1
    out.append((start, hi))
    return [(a, b) for a, b in out if a < b]


def _surges(size: list[float], a: int, b: int, least: float | None = None) -> bool:
    return any(sum(size[i : min(i + WINDOW, b)]) >= (SURGE if least is None else least) for i in range(a, b))


def _of_article(size: list[float], lo: int, hi: int) -> list[tuple[int, int]]:
    """What is kept of the marked lines lo to hi."""
    stretches = _between(size, lo, hi)
    if any(_surges(size, a, b) for a, b in stretches):
        return [(a, b) for a, b in stretches if _surges(size, a, b, 0 if a == lo or b == hi else SURGE)]
    return stretches if any(size[lo:hi]) else [(lo, hi)]


def _of_page(lines: list[Line], size: list[float], lo: int, hi: int) -> list[tuple[int, int]]:
    """What is kept of the unmarked lines lo to hi, without link lines at either end."""
    kept = []
    for a, b in _between(size, lo, hi):
        cuts = [a, *(i for i in range(a + 1, b) if lines[i].cut), b]
        surging = [(x, y) for x, y in zip(cuts, cuts[1:], strict=False) if _surges(size, x, y)]
        if surging:
            heavy = [i for i in range(surging[0][0], surging[-1][1]) if size[i]]
            kept.append((heavy[0], heavy[-1] + 1))
    return kept


def main_text(page: str | None) -> str:
    """The text between surges and dives."""
    lines = lines_of(page or "")
    size, kept, at = weights(lines), [], 0
    for inside, zone in groupby(lines, key=lambda x: x.inside):
        n = len(list(zone))
        kept += _of_article(size, at, at + n) if inside else _of_page(lines, size, at, at + n)
        at += n
    texts = [lines[i].text for a, b in kept for i in range(a, b)]
    return "\n".join(texts or [x.text for x, n in zip(lines, size, strict=True) if n] or [x.text for x in lines])


def _extract(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        texts = [main_text(h.as_py()) for h in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages (page_id, url, html)."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
