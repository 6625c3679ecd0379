"""Main text of web pages by composite text density.

The page becomes a tree of elements. Elements that are never article text by their kind (scripts, menus, footers and
so on) are cut off. Elements that their name, role or a hidden state marks as menus, adverts, forms, comments and the
like are marked down: they are left out of the densities, unless the text outside them is less than a quarter of the page's
and has no ``article`` or ``main``; then those that hold most of it, comments excepted, are not noise but the page. A class counts only as a whole:
``cookie-notice`` is a notice, ``notice-of-1848`` and ``with-sidebar`` are not.

For every element left the density is its characters per tag, adjusted by how much of both is links. The element with the
largest sum of its children's densities is the core; the smallest density on the path from the body to it is
the threshold that elements beside the path must reach to count as text as well. If the core lies
in an ``article`` or ``main`` element, that element bounds the text: the path ends there, and what
stands beside it counts as text if it reaches the threshold, is a first heading, or if at least half of
its characters are outside links (short paragraphs and sections fall below the threshold, but are text). Without such an
element, the same holds for what stands directly beside the core, below the body, and for first headings beside the path.

Defined cases: null or empty html gives empty text; a page without tags is one block; unclosed,
misnested and stray tags are read as browsers mostly do; of equal sums the element that comes first is the core; a very long or
deeply nested page is read in full; repeated pages give equal rows; other columns may have any name and are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame

from almsflow.llm.tables import arrow_map

# Element kinds and names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
            "head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
NEVER = set("head script style noscript template nav footer aside button select textarea input iframe object embed svg canvas "
            "audio video menu map title".split())
#: Marked down by kind: they may wrap a whole page.
KINDS = set("form dialog label".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form status tooltip".split())
NAMES = set("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted nav navbar navigation "
            "menu submenu breadcrumb breadcrumbs sidebar aside widget widgets footer header masthead topbar cookie cookies consent gdpr notice "
            "notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
            "recommended recommendations comment comments commentlist disqus reply replies respond discussion copyright pagination pager toolbar "
            "skip hidden disclaimer tags paywall".split())
REMARKS = set("comment comments commentlist disqus reply replies respond discussion".split())
#: What may stand beside such a name in one class.
BESIDE = set("area article bar block body bottom box center col column container content entry fixed form global group holder inner item items left "
             "line link links list main mobile outer page panel post primary right row secondary section site sticky strip text thread title top "
             "unit wrap wrapper zone".split())
#: A block of the first kind ends an open block of the second.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
ROOTS = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


_NOT_P = BLOCK - {"p"}


class Page(HTMLParser):
    """Elements in page order; ``parts`` of each are texts and child numbers."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.parts = ["#root"], [-1], [[]]
        #: Never text; marked down; marked down as readers' remarks.
        self.never, self.doubtful, self.remarks = [False], [False], [False]
        self.open, self.opened = [0], Counter()

    def _pop_to(self, place: int) -> None:
        self.opened.subtract(self.tags[i] for i in self.open[place:])
        del self.open[place:]

    def _find(self, names: set[str], stop: set[str] | None = None) -> int | None:
        if not any(self.opened[t] for t in names):  # else a search through a deep page for every tag
            return None
        for place in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[place]]
            if tag in names:
                return place
            if stop and tag in stop:
                return None
        return None

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and self._find({tag}) is not None:
            return
        if tag == "body" and (place := self._find({"head"})) is not None:
            self._pop_to(place)
        if tag in BLOCK and (place := self._find({"p"}, _NOT_P)) is not None:
            self._pop_to(place)
        if tag in HEADINGS and self.tags[self.open[-1]] in HEADINGS:
            self._pop_to(len(self.open) - 1)
        if tag in ENDS and (place := self._find(ENDS[tag], SCOPE[tag])) is not None:
            if tag == "tr":  # a row ends the cells of the row before, and that row
                place = self._find({"tr"}, {"table"}) or place
            self._pop_to(place)
        number = len(self.tags)
        parent = self.open[-1]
        self.tags.append(tag)
        self.parents.append(parent)
        self.parts.append([])
        self.never.append(tag in NEVER)
        doubtful, remarks = self._doubt(tag, dict(attrs))
        self.doubtful.append(doubtful)
        self.remarks.append(remarks)
        self.parts[parent].append(number)
        if tag not in VOID:
            self.open.append(number)
            self.opened[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "use", "circle", "rect", "g") and len(self.open) > 1:
            self._pop_to(len(self.open) - 1)

    def handle_endtag(self, tag):
        if tag in VOID or tag in ("html", "body"):
            return
        place = self._find({tag}, None if tag in BLOCK or tag in NEVER else BLOCK)
        if place is not None:
            self._pop_to(place)

    def handle_data(self, data):
        self.parts[self.open[-1]].append(data)

    def _doubt(self, tag: str, attrs: dict[str, str | None]) -> tuple[bool, bool]:
        """Whether kind, role, state or name speak against an element, and whether they say that readers wrote it."""
        if tag in ("html", "body", "main"):
            return False, False
        inside = any(self.opened[t] for t in ROOTS)
        if tag in KINDS or (tag == "header" and not inside):
            return True, False
        if not attrs:
            return False, False
        hidden = "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or re.search(r"display\s*:\s*none", (attrs.get("style") or "").lower())
        found = set()
        for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
            words = {t.lower() for t in _TOKEN.findall(name) if not t.isdigit()}
            known = words & NAMES
            if known == {"header"} and (inside or not words <= {"header", "site", "page", "global", "top", "main"}):
                continue
            if known == {"tags"} and inside:
                continue
            if known and words <= NAMES | BESIDE:
                found |= known
        if tag == "article":
            found &= REMARKS | {"ad", "ads", "advert", "sponsored", "promo", "related"}
        return bool(hidden or found or (attrs.get("role") or "").lower() in ROLES), bool(found & REMARKS)


def _cut(page: Page) -> list[bool]:
    """Which elements are no part of the page's text."""
    n = len(page.tags)
    plain, linked, never = [0] * n, [False] * n, list(page.never)
    for i in range(1, n):
        linked[i] = linked[page.parents[i]] or page.tags[i] == "a"
        never[i] = never[i] or never[page.parents[i]]
    for i in range(n - 1, -1, -1):  # children have larger numbers than their parents
        if not never[i]:
            plain[i] += 0 if linked[i] else sum(len(" ".join(p.split())) for p in page.parts[i] if isinstance(p, str))
            if i:
                plain[page.parents[i]] += plain[i]

    def without(marked: list[bool]) -> tuple[list[bool], int]:
        gone, left = list(never), plain[0]
        for i in range(1, n):
            if not gone[i] and marked[i] and not gone[page.parents[i]]:
                left -= plain[i]
            gone[i] = gone[i] or marked[i] or gone[page.parents[i]]
        return gone, left

    gone, left = without(page.doubtful)
    marked = any(page.tags[i] in ROOTS and plain[i] and not gone[i] for i in range(n))
    if 4 * left < plain[0] and not marked:
        gone, _ = without([d and (page.remarks[i] or 2 * plain[i] < plain[0]) for i, d in enumerate(page.doubtful)])
    return gone


def densities(page: Page, gone: list[bool]) -> tuple[list[float], list[float]]:
    """Composite density of every element, and the sum of its children's (own text as one child)."""
    n = len(page.tags)
    chars, tags, link_chars, link_tags, own = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):  # children have larger numbers than their parents
        if gone[i]:
            continue
        own[i] = sum(len(" ".join(p.split())) for p in page.parts[i] if isinstance(p, str))
        chars[i] += own[i]
        if page.tags[i] == "a":
            link_chars[i], link_tags[i] = chars[i], tags[i] + 1
        if (up := page.parents[i]) >= 0:
            chars[up] += chars[i]
            tags[up] += tags[i] + 1
            link_chars[up] += link_chars[i]
            link_tags[up] += link_tags[i]
    body = next((i for i, t in enumerate(page.tags) if t == "body"), 0)
    body_share = link_chars[body] / chars[body] if chars[body] else 0.0

    def density(c: int, t: int, lc: int, lt: int) -> float:
        if not c:
            return 0.0
        base = log(c / max(1, c - lc) * lc + body_share * c + e)
        return c / max(1, t) * log(max(1.0, c / max(1, lc) * max(1, t) / max(1, lt))) / log(max(base, e))

    dense = [density(*x) for x in zip(chars, tags, link_chars, link_tags)]
    sums = [density(c, 1, 0, 0) if c else 0.0 for c in own]
    for i in range(n - 1, 0, -1):
        if not gone[i]:
            sums[page.parents[i]] += dense[i]
    return dense, sums


def _blocks(page: Page, chosen: list[bool], gone: list[bool]) -> str:
    """Texts of the chosen elements in page order; block elements and line breaks part words."""
    out: list[str] = []
    stack: list[tuple[int, int]] = [(0, 0)]
    while stack:
        i, at = stack.pop()
        parts = page.parts[i]
        if at == 0 and (page.tags[i] in BLOCK or page.tags[i] == "br"):
            out.append("\n")
        while at < len(parts):
            part = parts[at]
            at += 1
            if isinstance(part, str):
                if chosen[i]:
                    out.append(part)
            elif not gone[part]:
                stack.append((i, at))
                stack.append((part, 0))
                break
        else:
            if page.tags[i] in BLOCK:
                out.append("\n")
    return " ".join("".join(out).split())


def _mostly_links(page: Page, top: int, gone: list[bool]) -> bool:
    """Whether more than half of the element's characters stand in links."""
    chars, linked, stack = 0, 0, [(top, False)]
    while stack:
        i, link = stack.pop()
        link = link or page.tags[i] == "a"
        for part in page.parts[i]:
            if not isinstance(part, str):
                if not gone[part]:
                    stack.append((part, link))
            elif n := len(" ".join(part.split())):
                chars += n
                linked += n if link else 0
    return 2 * linked > chars


def main_text(html: str | None) -> str:
    """The article of a page as one line of text."""
    if not html:
        return ""
    page = Page()
    page.feed(html)
    page.close()
    n, gone = len(page.tags), _cut(page)
    dense, sums = densities(page, gone)
    live = [i for i in range(n) if not gone[i]]
    core = max(live, key=lambda i: (sums[i], -i))
    path = [core]
    while page.parents[path[-1]] >= 0:
        path.append(page.parents[path[-1]])
    outer = max((place for place, i in enumerate(path) if page.tags[i] in ROOTS), default=None)
    if outer is not None:
        del path[outer + 1:]
    # The root and the html element are no part of the path from the body.
    floor = min((dense[i] for i in path if page.tags[i] not in ("#root", "html")), default=dense[core])
    on_path = set(path)
    beside = [i for i in live if i not in on_path and page.parents[i] in on_path - {core}]
    # What bounds the text: an article, or else the element round the core.
    near = on_path if outer is not None else {i for i in path[1:2] if page.tags[i] not in ("body", "html", "#root")}
    tops = {core} | {i for i in beside if dense[i] >= floor or ((page.tags[i] == "h1" or page.parents[i] in near) and (page.tags[i] == "h1" or not _mostly_links(page, i, gone)))}
    chosen = [False] * n
    for i in on_path - {core}:  # text that stands directly on the path
        chosen[i] = dense[i] >= floor
    for i in live:
        chosen[i] = chosen[i] or i in tops or (page.parents[i] >= 0 and page.parents[i] not in path[1:] and chosen[page.parents[i]])
    return _blocks(page, chosen, gone)


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                          names=["page_id", "url", "text", "n_chars"])

    kind = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return arrow_map(pages.select("page_id", "url", "html"), read, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
