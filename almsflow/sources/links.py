"""Download links of HTML pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import DataFrame

from almsflow.operators.extract import in_batches

LINK_SCHEMA = "page_id long, pos int, href string, full_url string, kind string"


class _Anchors(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.hrefs: list[str] = []

    def handle_starttag(self, tag, attrs):
        target = dict(attrs).get("href") if tag == "a" else None
        if target is not None:
            self.hrefs.append(target)


def link_kind(href: str) -> str:
    return next((kind for kind in ("zip", "csv") if href.endswith(f".{kind}")), "other")


def _absolute(base: str, href: str) -> str | None:
    try:
        return urljoin(base, href)
    except ValueError:
        return None


def page_links(pages: DataFrame) -> DataFrame:
    """``(page_id, pos, href, full_url, kind)`` for every anchor of ``(page_id, url, html)``
    pages; ``kind`` tells zip and csv downloads (case-sensitive) from the rest."""
    def links(page: dict) -> Iterator[dict]:
        parser = _Anchors()
        parser.feed(page["html"] or "")
        parser.close()
        for pos, href in enumerate(parser.hrefs):
            yield {"page_id": page["page_id"], "pos": pos, "href": href,
                   "full_url": _absolute(page["url"] or "", href), "kind": link_kind(href)}

    return pages.select("page_id", "url", "html").mapInArrow(in_batches(links, LINK_SCHEMA), LINK_SCHEMA)
