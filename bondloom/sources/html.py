"""Links of index pages, and guards on landed files."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words in a link's squeezed label, the page's body and the path of files, and
# the marks of a challenge page.
KINDS = (("outright", "volumes"), ("summaryrepor", "daily_summary"))
BODY_CLASS, FILE_PATH = "page-template--body__content", "/api/file/"
CHALLENGE = ("sucuri_cloudproxy", "You are being redirected", "Javascript is required")
SNIFFED, CLIMB, CONTEXT = 8192, 4, 200
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
LINKS = "page string, href string, label string, kind string, label_day date, posted_day date, amended boolean, place int"
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


class Node:
    """An element with its attributes, its parent, and its texts and children in order."""

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.parts: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [p for p in reversed(node.parts) if isinstance(p, Node)]

    def text(self) -> str:
        """All text below, parted and squeezed by single blanks."""
        found, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                found.append(node)
            else:
                stack += reversed(node.parts)
        return " ".join(" ".join(found).split())


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # A paragraph ends where the next begins.
        if tag == "p":
            self._close("p")
        node = Node(tag, dict(attrs), self.at)
        self.at.parts.append(node)
        if tag not in VOID:
            self.at = node

    def _close(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_endtag(self, tag: str) -> None:
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.at.tag not in ("script", "style"):
            self.at.parts.append(data)


def page_body(html: str) -> Node:
    """The page's content, which the rest of the page may repeat; the whole page without one."""
    tree = _Tree()
    tree.feed(html)
    return next((n for n in tree.root.walk() if BODY_CLASS in (n.attrs.get("class") or "").split()), tree.root)


def numeric_day(text: str) -> dt.date | None:
    """First d.m.yyyy, blanks inside ignored, from 2000 to 2069."""
    found = re.search(r"(\d{1,2})\.(\d{1,2})\.(\d{4})", re.sub(r"\s+", "", text))
    return _sane(*map(int, found.groups()[::-1])) if found else None


def spelled_day(text: str) -> dt.date | None:
    found = re.search(r"(\d{1,2})\s*(?:st|nd|rd|th)?\s+([A-Za-z]+)\s+(\d{4})", text)
    if not found or found[2].lower() not in MONTHS:
        return None
    return _sane(int(found[3]), MONTHS.index(found[2].lower()) + 1, int(found[1]))


def _sane(year: int, month: int, day: int) -> dt.date | None:
    try:
        read = dt.date(year, month, day)
    except ValueError:
        return None
    return read if dt.date(2000, 1, 1) <= read <= dt.date(2070, 1, 1) else None


def kind_of(label: str) -> str | None:
    squeezed = "".join(label.lower().split())
    return next((kind for word, kind in KINDS if word in squeezed), None)


Link = tuple[str, str, str, dt.date | None, dt.date | None, bool]


def _files(body: Node, base: str) -> Iterator[tuple[str, Node]]:
    for node in body.walk():
        href = node.attrs.get("href") if node.tag == "a" else None
        if href and FILE_PATH in href:
            yield (base + href if href.startswith("/") else href), node


def daily_links(body: Node, base: str) -> Iterator[Link]:
    """Per paragraph the links of volumes and summaries; fragments of one link are one label.
    A link without a label is another row's, and the first row that names a link counts."""
    seen = set()
    for row in (n for n in body.walk() if n.tag == "p"):
        labels: dict[str, str] = {}
        for href, node in _files(row, base):
            labels[href] = (labels.get(href, "") + node.text()).strip()
        posted = numeric_day(row.text()) if labels else None
        for href, label in labels.items():
            kind = kind_of(label)
            if kind and href not in seen:
                seen.add(href)
                yield href, label, kind, numeric_day(label) if kind == "volumes" else None, posted, kind == "daily_summary" and "amended" in label.lower()


def _either_day(text: str) -> dt.date | None:
    return spelled_day(text) or numeric_day(text)


def _around(node: Node, cut: int | None = None) -> dt.date | None:
    """The day of the nearest element around a link that has one, CLIMB steps up at most."""
    for _ in range(CLIMB):
        if node.parent is None:
            return None
        node = node.parent
        day = _either_day(node.text()[:cut])
        if day:
            return day
    return None


def trade_links(body: Node, base: str) -> Iterator[Link]:
    seen = set()
    for href, node in _files(body, base):
        if href not in seen:
            seen.add(href)
            label = node.text()
            yield href, label, "trade_summary", _either_day(label) or _around(node), None, False


def auction_links(body: Node, base: str) -> Iterator[Link]:
    """English releases alone; the day of the label, and that of the row as posted."""
    seen = set()
    for href, node in _files(body, base):
        label = node.text()
        if href not in seen and "english" in label.lower():
            seen.add(href)
            yield href, label, "bond_auction", spelled_day(label), numeric_day(node.parent.text()) if node.parent else None, False


def notice_links(body: Node, base: str) -> Iterator[Link]:
    """English announcements alone; the label is the language, the day stands around it."""
    seen = set()
    for href, node in _files(body, base):
        label = node.text()
        if href not in seen and "english" in label.lower():
            seen.add(href)
            yield href, label, "bond_issuance", _around(node, CONTEXT), None, False


#: The readers by section of an index.
SECTIONS: dict[str, Callable[[Node, str], Iterator[Link]]] = {"daily": daily_links, "trade-summary": trade_links, "bond-issuance": notice_links, "bond-auction": auction_links}


def index_links(pages: DataFrame, *, page: str = "page", html: str = "html", section: str = "section", base: str = "") -> DataFrame:
    """LINKS of index pages (page, html, section of SECTIONS). ``base`` is put before links
    that begin with a slash. Null pages and unknown sections have none."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in LINKS.split(", ")]
        for batch in batches:
            rows = []
            for name, text, kind in zip(batch["page"], batch["html"], batch["section"]):
                rows += [(name, *link, place) for place, link in enumerate(SECTIONS[kind](page_body(text), base))]
            yield pd.DataFrame(rows, columns=columns)

    slim = pages.select(F.col(page).cast("string").alias("page"), F.col(html).alias("html"), F.col(section).alias("section"))
    return slim.where(F.col("html").isNotNull() & F.col("section").isin(*SECTIONS)).mapInPandas(read, LINKS)


def file_id(url: Column) -> Column:
    """The last part of a link's path."""
    return F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)


def guarded(files: DataFrame, content: str = "content", status: str | None = None) -> DataFrame:
    """Landed files with their digest, without short challenge pages and, where a ``status``
    column is named, without answers of 300 and more."""
    text = F.decode(F.substring(F.col(content), 1, SNIFFED), "ISO-8859-1")
    challenge = F.array_contains(F.array(*[F.contains(text, F.lit(word)) for word in CHALLENGE]), True)
    bad = (F.length(F.col(content)) <= SNIFFED) & challenge
    kept = files.where(~bad) if status is None else files.where(~bad & (F.col(status) < 300))
    return kept.withColumn("sha256", F.sha2(F.col(content), 256))


def work_order(links: DataFrame, done: DataFrame, only_new: bool = True) -> DataFrame:
    """``links`` with ``ingest_seq``, the order files are taken in: announcements, results,
    volumes, trades, quotes, in each the oldest first, so that labels come before the quotes
    that need them and an amended file after its original. ``done`` (url, parse_status): files
    read well before are left out."""
    kinds = ("bond_issuance", "bond_auction", "volumes", "trade_summary", "daily_summary")
    rank = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind"))
    day = F.coalesce("posted_day", "label_day", F.lit("0001-01-01").cast("date"))
    left = links.join(done.where("parse_status = 'ok'").select(F.col("url").alias("href")), "href", "left_anti") if only_new else links
    # A link listed by several pages is taken once.
    first = left.groupBy("href").agg(F.min(F.struct(rank.alias("rank"), day.alias("day"), "page", "place")).alias("o"), F.first("kind").alias("kind"), F.first("label_day").alias("label_day"), F.max("posted_day").alias("posted_day"), F.max("amended").alias("amended"))
    return first.select(F.struct("o.rank", "o.day", "o.page", "o.place", "href").alias("ingest_seq"), "href", file_id(F.col("href")).alias("file_id"), "kind", "label_day", "posted_day", "amended")
