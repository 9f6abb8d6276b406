"""HTML extraction, each page parsed once in an Arrow batch."""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import functions as F

from weftline.functions.text import col

# Content areas in order of preference, and elements whose own text is left out.
AREAS = ("main", "article", ".content", "#content", ".main-content", "body")
EXCLUDED = frozenset(("script", "style", "nav", "header", "footer", "aside"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
                  "track", "wbr"))
HEAD_ONLY = frozenset(("html", "head", "title", "meta", "link", "base", "script", "style", "noscript"))
SELF_CLOSING = frozenset(("p", "li", "option", "tr", "td", "th", "dt", "dd"))  # ended by the next one
MIN_AREA_CHARS = 200
EXTRACTED = "struct<title:string,text:string,links:array<string>>"


class _Page(HTMLParser):
    """Collects text nodes by area, titles and hrefs while the tags stream past."""

    def __init__(self, exclude_subtrees: bool):
        super().__init__(convert_charrefs=True)
        self.whole_subtrees = exclude_subtrees
        self.stack = []  # (tag, areas the element matches)
        self.opened = Counter()
        self.inside = Counter()
        self.chunk = []
        self.areas = {name: [] for name in AREAS}
        self.first = {}
        self.hrefs = []
        self.area_hrefs = []

    def _push(self, tag, areas):
        self.stack.append((tag, areas))
        self.opened[tag] += 1
        self.inside.update(areas)

    def _pop(self):
        tag, areas = self.stack.pop()
        self.opened[tag] -= 1
        self.inside.subtract(areas)
        return tag

    def _close(self, tag):
        while self.opened[tag] and self._pop() != tag:
            pass

    def _flush(self):
        node, self.chunk = "".join(self.chunk), []
        if not node or not self.stack:
            return
        parent, own = self.stack[-1]
        if parent in ("title", "h1"):
            self.first.setdefault(parent, node)
        if parent in EXCLUDED or (self.whole_subtrees and any(self.opened[t] for t in EXCLUDED)):
            return
        for name in AREAS:
            if self.inside[name] - own.count(name) > 0:
                self.areas[name].append(node)

    def handle_starttag(self, tag, attrs):
        self._flush()
        given = dict(reversed(attrs))
        if tag == "a" and given.get("href") is not None:
            self.hrefs.append(given["href"])
        if tag == "area" and given.get("href") is not None:
            self.area_hrefs.append(given["href"])
        if tag == "body" and self.opened["body"]:
            return
        if tag not in HEAD_ONLY:
            self._close("head")
            if tag != "body" and not self.opened["body"]:
                self._push("body", ["body"])
        if tag in VOID:
            return
        if tag in SELF_CLOSING and self.stack and self.stack[-1][0] == tag:
            self._pop()
        classes = (given.get("class") or "").split()
        self._push(tag, [a for a in AREAS if a == tag or (a[0] == "." and a[1:] in classes)
                         or (a[0] == "#" and a[1:] == given.get("id"))])

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self._flush()
        self._close(tag)

    def handle_data(self, data):
        if not self.stack and data.strip():
            self._push("body", ["body"])
        self.chunk.append(data)

    def handle_comment(self, data):
        self._flush()

    def close(self):
        super().close()
        self._flush()


def parse_page(html: str, exclude_subtrees: bool = False) -> _Page:
    page = _Page(exclude_subtrees)
    page.feed(html)
    page.close()
    return page


def page_title(page: _Page) -> str:
    for tag in ("title", "h1"):
        if page.first.get(tag):
            return page.first[tag].strip()
    return "No Title"


def page_text(page: _Page) -> str:
    for name in AREAS:
        text = re.sub(r"\s+", " ", " ".join(page.areas[name]).strip())
        if len(text) > MIN_AREA_CHARS:
            return text
    return ""


def page_links(page: _Page, url: str, areas: bool = False) -> list:
    found = set()
    for href in page.hrefs + page.area_hrefs if areas else page.hrefs:
        try:
            target = urljoin(url, href)
            parts = urlparse(target)
        except ValueError:
            continue
        if parts.scheme in ("http", "https") and not parts.fragment:
            found.add(target)
    return sorted(found)


def html_extract(html, url, exclude_subtrees: bool = False, areas: bool = False):
    """struct<title, text, links>; NULL for a page that cannot be parsed."""

    @F.pandas_udf(EXTRACTED)
    def extract(pages: pd.Series, urls: pd.Series) -> pd.DataFrame:
        rows = []
        for body, address in zip(pages, urls):
            try:
                page = parse_page(body, exclude_subtrees)
                rows.append((page_title(page), page_text(page), page_links(page, address, areas)))
            except Exception:
                rows.append((None, None, None))
        return pd.DataFrame(rows, columns=["title", "text", "links"])

    # not repeated for a filter above it
    return extract.asNondeterministic()(col(html), col(url))


def extract_title(html):
    return html_extract(html, F.lit(""))["title"]


def extract_main_text(html, exclude_subtrees: bool = False):
    return html_extract(html, F.lit(""), exclude_subtrees)["text"]


def extract_links(html, url, areas: bool = False):
    """The links alone, so that neither titles nor texts leave the task; NULL for a page that cannot be parsed."""

    @F.pandas_udf("array<string>")
    def extract(pages: pd.Series, urls: pd.Series) -> pd.Series:
        rows = []
        for body, address in zip(pages, urls):
            try:
                rows.append(page_links(parse_page(body), address, areas))
            except Exception:
                rows.append(None)
        return pd.Series(rows, dtype=object)

    return extract.asNondeterministic()(col(html), col(url))


def cap_links(links, n: int = 100):
    return F.slice(F.array_sort(col(links)), 1, n)
