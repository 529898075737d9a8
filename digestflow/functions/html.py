"""Text and dates of HTML pages: one pass over the parser's events gathers ranked findings, the best finding answers.

While a page streams by, every element that may hold an answer opens a pocket that collects the text inside it; attributes that answer by
themselves become findings at once. Nothing is kept of the page but its pockets. Batches are Arrow UDFs.
"""

from __future__ import annotations

import json
import re
from calendar import month_abbr, month_name
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime, tzinfo
from email.utils import parsedate_to_datetime
from html.parser import HTMLParser
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_LIMIT = 10_000
BYLINE = 60
LEAD = 2_000
# Elements outside the article, article containers in order of preference, meta keys and types that carry a date.
DROPPED = frozenset({"script", "style", "noscript", "nav", "header", "footer", "aside", "form", "svg"})
CONTAINERS = (("itemprop", "articleBody"), ("tag", "article"), ("role", "main"), ("tag", "main"), ("class", "article-body"), ("class", "article-content"), ("class", "entry-content"), ("class", "entry"), ("class", "post-content"))
META_DATES = frozenset({"article:published_time", "citation_publication_date", "date", "datepublished", "dc.date", "dc.date.issued", "og:published_time", "parsely-pub-date", "pubdate", "publish-date"})
ARTICLE_TYPES = frozenset({"article", "blogposting", "newsarticle", "report", "scholarlyarticle", "techarticle"})
_VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"})
_HIDDEN = frozenset({"script", "style"})
_MONTH_OF = {name.lower(): i for names in (month_name, month_abbr) for i, name in enumerate(names) if name}
_WRITTEN = re.compile(r"\b(?:(?P<month>[A-Za-z]{3,9})\.?\s+(?P<day>\d{1,2}),\s+(?P<year>\d{4})|(?P<iso>20\d{2}-\d{2}-\d{2})(?:\s+(?P<clock>\d{2}:\d{2}:\d{2}))?)\b")
_DATE_LIKE = re.compile(r"\d{4}\s*[-/年]\s*\d{1,2}\s*[-/月]\s*\d{1,2}")
_CLOCK = re.compile(r"\d{1,2}:\d{2}(?::\d{2})?")
_DATED_CLASS = re.compile(r"date|time|publish")


def squeeze(parts: Iterable[str]) -> str:
    return " ".join(" ".join(parts).split())


@dataclass
class Pocket:
    """Text collected inside one element. depth: how deep the element stands; bare: parts of the page outside the article are left out."""

    kind: str
    rank: int
    depth: int
    bare: bool = True
    parts: list[str] = field(default_factory=list)

    def text(self) -> str:
        return squeeze(self.parts)


class PageScan(HTMLParser):
    """Pockets and attribute findings of one page, in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.path: list[str] = []
        self.live: list[Pocket] = []
        self.pockets: list[Pocket] = [Pocket("page", 0, -1, False)]
        self.metas: list[tuple[str, str]] = []
        self.times: list[str] = []
        self.links: list[tuple[str, Pocket]] = []
        self._boxed = -1  # depth of the first article or main element, while it is open
        self._box_seen = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        has = {k: v or "" for k, v in attrs}
        depth = len(self.path)
        if tag == "meta":
            self.metas += [(has[k].lower(), has.get("content", "")) for k in ("property", "name", "itemprop") if has.get(k)][:1]
        if tag in _VOID:
            return
        opened: list[Pocket] = []
        classes = has.get("class", "")
        for rank, (kind, name) in enumerate(CONTAINERS):
            if (kind == "tag" and tag == name) or (kind == "class" and name in classes.split()) or (kind not in ("tag", "class") and has.get(kind) == name):
                opened.append(Pocket("body", rank, depth))
        if tag in ("article", "main") and not self._box_seen:
            self._box_seen, self._boxed = True, depth
            opened.append(Pocket("box", 0, depth, False))
        if tag == "time" and self._boxed >= 0 and has.get("datetime"):
            self.times.append(has["datetime"])
        if _DATED_CLASS.search(classes):
            opened.append(Pocket("byline", 0, depth, False))
        if tag == "title":
            opened.append(Pocket("title", 0, depth, False))
        if tag == "script" and has.get("type") == "application/ld+json":
            opened.append(Pocket("data", 0, depth, False))
        if tag == "a" and has.get("href"):
            link = Pocket("link", 0, depth, False)
            opened.append(link)
            self.links.append((has["href"], link))
        self.path.append(tag)
        self.pockets += opened
        self.live += opened

    def handle_endtag(self, tag: str) -> None:
        if tag not in self.path:
            return
        depth = len(self.path) - 1 - self.path[::-1].index(tag)
        del self.path[depth:]
        self.live = [p for p in self.live if p.depth < depth]
        if self._boxed >= depth:
            self._boxed = -1

    def handle_data(self, data: str) -> None:
        hidden = bool(self.path) and self.path[-1] in _HIDDEN
        if not hidden:
            self.pockets[0].parts.append(data)
        dropped = max((i for i, t in enumerate(self.path) if t in DROPPED), default=-1)
        for pocket in self.live:
            if pocket.kind == "data" or (not hidden and (not pocket.bare or dropped <= pocket.depth)):
                pocket.parts.append(data)

    def of(self, kind: str) -> list[Pocket]:
        return [p for p in self.pockets if p.kind == kind]

    def structured(self) -> list[dict]:
        """The article records of the structured data, outer ones first; unreadable data counts as none."""
        out: list[dict] = []
        for pocket in self.of("data"):
            try:
                todo = [json.loads("".join(pocket.parts))]
            except (json.JSONDecodeError, RecursionError):
                continue
            while todo:
                value = todo.pop(0)
                if isinstance(value, dict):
                    kinds = value.get("@type")
                    if ARTICLE_TYPES.intersection(str(k).lower() for k in (kinds if isinstance(kinds, list) else [kinds])):
                        out.append(value)
                    value = list(value.values())
                if isinstance(value, list):
                    todo = [v for v in value if isinstance(v, (dict, list))] + todo
        return out


def scan(markup: str) -> PageScan:
    page = PageScan()
    page.feed(markup)
    page.close()
    return page


def plain_text_of(markup: str | None) -> str:
    """Text without tags, entities decoded, white space collapsed; empty for null."""
    return scan(markup).pockets[0].text() if markup else ""


def meta_of(page: PageScan, key: str) -> str:
    """Content of the first meta element of that key, else an empty text."""
    return next((content for k, content in page.metas if k == key), "")


def _article(page: PageScan) -> str:
    bodies = [(p.rank, text) for p in page.of("body") if (text := p.text())]
    best = min((rank for rank, _ in bodies), default=0)
    texts = [squeeze([str(a["articleBody"])]) for a in page.structured() if a.get("articleBody")]
    return max([*texts, *(text for rank, text in bodies if rank == best)], key=len, default="")[:TEXT_LIMIT]


def article_text_of(markup: str | None) -> str:
    """The longest text of the most preferred container kind with any text, or of the structured bodies, cut at TEXT_LIMIT."""
    return _article(scan(markup)) if markup else ""


def published_of(value: str | None) -> datetime | None:
    """A machine-readable date as UTC; a bare wall clock is UTC."""
    for read in (parsedate_to_datetime, lambda v: datetime.fromisoformat(v.strip().replace("Z", "+00:00"))):
        try:
            found = read(value or "")
        except (TypeError, ValueError, IndexError):
            continue
        return found.astimezone(UTC) if found.tzinfo else found.replace(tzinfo=UTC)
    return None


def date_in_text(value: str, zone: tzinfo = UTC) -> datetime | None:
    """A date written in running text: an English long date, else an ISO date with or without a clock, read in `zone`."""
    written = sorted(_WRITTEN.finditer(value), key=lambda m: m["iso"] is not None)
    for m in written:
        try:
            if m["iso"]:
                found = datetime.fromisoformat(f"{m['iso']}T{m['clock'] or '00:00:00'}")
            elif m["month"].lower() in _MONTH_OF:
                found = datetime(int(m["year"]), _MONTH_OF[m["month"].lower()], int(m["day"]))  # noqa: DTZ001  the zone follows
            else:
                continue
            return found.replace(tzinfo=zone).astimezone(UTC)
        except ValueError:
            continue
    return None


def _byline(page: PageScan) -> str:
    """The first date-like text of the elements whose class tells of a date, and the first bare clock beside it."""
    texts = [text[:BYLINE] for p in page.of("byline")[:30] if (text := p.text())]
    date = next((t for t in texts if _DATE_LIKE.search(t)), None)
    clock = next((t for t in texts if _CLOCK.fullmatch(t)), None)
    return " ".join(t for t in (date, clock) if t) if date else ""


def _findings(page: PageScan, zone: tzinfo) -> Iterator[datetime | None]:
    """Dates of a page from the most to the least trusted place."""
    yield from (published_of(content) for key, content in page.metas if key in META_DATES)
    yield from (published_of(str(a["datePublished"])) for a in page.structured() if a.get("datePublished"))
    yield from map(published_of, page.times)
    yield date_in_text(_byline(page), zone)
    yield from (date_in_text(p.text()[:LEAD], zone) for p in page.of("box"))


def _date(page: PageScan, zone: tzinfo = UTC) -> datetime | None:
    return next((found for found in _findings(page, zone) if found is not None), None)


def page_date_of(markup: str | None, zone: str = "UTC") -> datetime | None:
    """Date of a page: meta keys, structured data, time elements of the first container, dated classes, then its first words; bare clocks are read in `zone`."""
    return _date(scan(markup), ZoneInfo(zone)) if markup else None


def summary_of(markup: str | None, zone: str = "UTC") -> dict:
    """What one reading of a page tells: title, description, article text and date."""
    page = scan(markup or "")
    title = meta_of(page, "og:title") or next((t for p in page.of("title") if (t := p.text())), "")
    return {"title": title, "description": plain_text_of(meta_of(page, "og:description")), "text": _article(page), "published": _date(page, ZoneInfo(zone))}


def plain_text(markup: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(plain_text_of), "string")(markup)


def article_text(markup: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(article_text_of), "string")(markup)


def page_date(markup: Column, zone: Column | None = None) -> Column:
    """UTC timestamp of a page, null where none is found."""

    def dates(s: pd.Series, z: pd.Series) -> pd.Series:
        return pd.to_datetime(pd.Series([page_date_of(m, t or "UTC") for m, t in zip(s, z, strict=True)], dtype=object), utc=True)

    return F.pandas_udf(dates, "timestamp")(markup, F.lit("UTC") if zone is None else zone)


def page_summary(markup: Column, zone: Column) -> Column:
    """struct(title, description, text, published_us) of a page in one reading."""

    def read(s: pd.Series, z: pd.Series) -> pd.DataFrame:
        rows = [summary_of(m, t or "UTC") for m, t in zip(s, z, strict=True)]
        stamps = [int(r["published"].timestamp()) * 1_000_000 + r["published"].microsecond if r["published"] else None for r in rows]
        return pd.DataFrame({"title": [r["title"] for r in rows], "description": [r["description"] for r in rows], "text": [r["text"] for r in rows], "published_us": pd.array(stamps, dtype="Int64")})

    return F.pandas_udf(read, "title string, description string, text string, published_us long")(markup, zone)
