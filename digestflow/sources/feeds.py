"""Readers that turn fetched payloads of feeds into items of one schema.

payloads(source, kind, url, body[, http_status]) hold what was fetched, one row for each source or page; fetching itself is outside the engine. A payload
that cannot be read gives no items and a failed row in `health`, never a failed job. Sources may carry display_name, namespace, link_pattern,
item_limit, source_channel and source_region; missing columns count as null. Pages of single articles, pages(url, body), are joined by URL.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestflow.functions import html, urls

ITEM_SCHEMA = "source string, source_item_id string, url string, title string, summary string, published_at string, source_time_kind string, author string, metrics map<string,string>, place int, error string"
BODY_LIMIT = 10_000


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1].lower()


def _child(node: ET.Element, *names: str) -> str:
    for name in names:
        for c in node:
            if _local(c.tag) == name and (c.text or "").strip():
                return c.text.strip()
    return ""


def _link(node: ET.Element) -> str:
    for c in node:
        if _local(c.tag) == "link" and c.get("href") and c.get("rel", "alternate") == "alternate":
            return c.get("href", "")
    return _child(node, "link")


def read_rss(body: str, url: str) -> list[dict]:
    """RSS and Atom entries with a link and a title; the longest content, else the summary, without markup."""
    out = []
    for node in ET.fromstring(body).iter():
        if _local(node.tag) not in ("item", "entry"):
            continue
        link, title = _link(node), html.plain_text_of(_child(node, "title"))
        if not link or not title:
            continue
        contents = [html.plain_text_of("".join(c.itertext())) for c in node if _local(c.tag) in ("encoded", "content")]
        text = max(contents, key=len, default="") or html.plain_text_of(_child(node, "summary", "description"))
        author = next((_child(c, "name") or (c.text or "").strip() for c in node if _local(c.tag) in ("author", "creator")), None)
        out.append({"source_item_id": _child(node, "guid", "id") or link, "url": urljoin(url, link), "title": title[:500], "summary": text[:BODY_LIMIT], "published_at": _child(node, "pubdate", "published", "updated", "date") or None, "author": author or None})
    return out


def read_arxiv(body: str, url: str) -> list[dict]:
    """Atom entries of papers: white space collapsed, authors joined."""
    out = []
    for node in ET.fromstring(body).iter():
        if _local(node.tag) == "entry":
            names = [" ".join("".join(a.itertext()).split()) for a in node if _local(a.tag) == "author"]
            out.append({"source_item_id": _child(node, "id"), "url": _child(node, "id"), "title": " ".join(_child(node, "title").split()), "summary": " ".join(_child(node, "summary").split())[:BODY_LIMIT], "published_at": _child(node, "published") or None, "author": ", ".join(names) or None})
    return [x for x in out if x["url"] and x["title"]]


def read_stories(body: str, url: str) -> list[dict]:
    """Submitted stories: an array of records with type, title, url, time, score and comments."""
    out = []
    for x in json.loads(body):
        if isinstance(x, dict) and x.get("type") == "story" and x.get("title"):
            out.append({"source_item_id": str(x.get("id")), "url": x.get("url") or urljoin(url, f"item?id={x.get('id')}"), "title": str(x["title"])[:500], "summary": html.plain_text_of(x.get("text"))[:BODY_LIMIT], "source_time_kind": "community_submitted", "author": x.get("by"), "metrics": {"score": str(x.get("score", 0)), "comments": str(x.get("descendants", 0))}})
    return out


def read_releases(body: str, url: str, label: str = "") -> list[dict]:
    """Releases that are no drafts, titled with the source's label."""
    out = []
    for x in json.loads(body):
        name = x.get("name") or x.get("tag_name")
        if not x.get("draft") and name and x.get("html_url"):
            out.append({"source_item_id": str(x.get("id")), "url": x["html_url"], "title": f"{label}: {name}" if label else name, "summary": (x.get("body") or "")[:BODY_LIMIT], "published_at": x.get("published_at"), "author": (x.get("author") or {}).get("login")})
    return out


def read_papers(body: str, url: str) -> list[dict]:
    """Papers of a daily list, nested or flat; rows without id or title are skipped."""
    out = []
    for x in json.loads(body):
        p = x.get("paper") or x
        name = p.get("id") or p.get("paperId")
        if name and p.get("title"):
            out.append({"source_item_id": str(name), "url": urljoin(url, str(name)), "title": " ".join(str(p["title"]).split()), "summary": " ".join(str(p.get("summary") or p.get("abstract") or "").split())[:BODY_LIMIT], "published_at": p.get("publishedAt"), "metrics": {"upvotes": str(x.get("numUpvotes", p.get("upvotes", 0)))}})
    return out


def read_models(body: str, url: str, label: str = "", namespace: str = "") -> list[dict]:
    """Public repositories of the namespace that are no quantised copies and tell when they changed."""
    out = []
    for x in json.loads(body):
        tags = [str(t) for t in x.get("tags") or []]
        name = x.get("modelId") or x.get("id")
        kept = name and (not namespace or str(name).startswith(f"{namespace}/")) and not x.get("private") and html.published_of(x.get("lastModified"))
        if kept and not any(t.startswith("base_model:quantized:") for t in tags):
            told = f"{name} changed at {x['lastModified']}; task {x.get('pipeline_tag') or 'unspecified'}; tags {', '.join(tags[:20])}"
            short = str(name).split("/", 1)[-1]
            out.append({"source_item_id": f"{name}@{x.get('sha') or x['lastModified']}", "url": urljoin(url, f"/{name}"), "title": f"{label}: {short} repository update" if label else short, "summary": told[:BODY_LIMIT], "published_at": x["lastModified"], "source_time_kind": "repository_updated", "metrics": {"likes": str(x.get("likes", 0)), "downloads": str(x.get("downloads", 0))}})
    return out


def read_index(body: str, url: str, pattern: str = "") -> list[dict]:
    """Links of an index page that fit the pattern, in document order, each once; the listing text stands in for a title until the page is read."""
    fits = re.compile(pattern or "")
    out: dict[str, dict] = {}
    for href, link in html.scan(body).links:
        target = urljoin(url, href)
        if re.match(r"https?://", target) and fits.search(target) and (title := link.text()):
            out.setdefault(target, {"source_item_id": target, "url": target, "title": title[:500], "summary": ""})
    return list(out.values())


# kind -> reader and the attributes of the source it takes
READERS: dict[str, tuple[Callable[..., list[dict]], tuple[str, ...]]] = {
    "rss": (read_rss, ()), "arxiv": (read_arxiv, ()), "hackernews": (read_stories, ()), "github_releases": (read_releases, ("display_name",)),
    "huggingface": (read_papers, ()), "huggingface_models": (read_models, ("display_name", "namespace")), "html_index": (read_index, ("link_pattern",)),
}
TRAITS = ("display_name", "namespace", "link_pattern", "item_limit", "source_channel", "source_region")
NOT_MODIFIED = 304


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in ITEM_SCHEMA.split(", ")]
    for batch in batches:
        rows = []
        for r in batch.astype(object).where(batch.notna(), None).to_dict("records"):
            source = r["source"]
            if r["http_status"] == NOT_MODIFIED:
                rows.append({"source": source, "error": "NotModified"})
                continue
            try:
                reader, traits = READERS[r["kind"]]
                found = reader(r["body"] or "", r["url"] or "", *(r[t] or "" for t in traits))
                found = found[: int(r["item_limit"])] if r["item_limit"] is not None else found
                rows += [{"source": source, "source_time_kind": "published", "place": i, **x} for i, x in enumerate(found, 1)]
                if not found:
                    rows.append({"source": source, "error": "Empty"})
            except Exception as e:  # noqa: BLE001  an unreadable payload is a row, not a failed task
                rows.append({"source": source, "error": type(e).__name__})
        yield pd.DataFrame(rows, columns=columns).astype(object).where(lambda d: d.notna(), None)


def _traits(sources: DataFrame) -> DataFrame:
    """One row for each source with every trait, null where the table has no such column."""
    return sources.where("source is not null").select(F.col("source").alias("_s"), *[F.col(t) if t in sources.columns else F.lit(None).cast("string").alias(t) for t in TRAITS]).dropDuplicates(["_s"])


def read_payloads(payloads: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Items and error rows (`error` set) of fetched payloads, at most item_limit of each payload."""
    status = F.col("http_status").cast("int") if "http_status" in payloads.columns else F.lit(None).cast("int")
    told = payloads.select("source", "kind", "url", "body", status.alias("http_status"))
    if sources is None:
        told = told.select("*", *[F.lit(None).cast("string").alias(t) for t in TRAITS])
    else:
        told = told.join(_traits(sources), F.col("source") == F.col("_s"), "left").drop("_s")
    return told.mapInPandas(_read, ITEM_SCHEMA)


def _zone() -> Column:
    return F.when(F.col("source_region") == "china", "Asia/Shanghai").otherwise("UTC")


def _stamp(micros: Column) -> Column:
    return F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def fill_dates(items: DataFrame, pages: DataFrame, sources: DataFrame) -> DataFrame:
    """items with published_at of undated ones taken from their page, where it stands on the source's own origin; `error` PageUndated where the page tells none.

    Only undated items are joined, and of each page only the date travels.
    """
    own = sources.select(F.col("source").alias("_s"), urls.origin(F.col("url")).alias("_origin")).dropDuplicates(["_s"])
    marked = items.join(own, F.col("source") == F.col("_s"), "left").drop("_s")
    waits = F.col("error").isNull() & F.col("published_at").isNull() & (urls.origin(F.col("url")) == F.col("_origin"))
    marked = marked.withColumn("_waits", F.coalesce(waits, F.lit(False)))
    asked = marked.where("_waits").select(F.col("url").alias("_url")).distinct()
    dated = pages.join(asked, F.col("url") == F.col("_url"), "left_semi").groupBy(F.col("url").alias("_url")).agg(F.min(html.page_date(F.col("body"))).alias("_date"))
    joined = marked.where("_waits").join(dated, F.col("url") == F.col("_url"), "left")
    found = joined.withColumn("published_at", _stamp(F.unix_micros("_date"))).withColumn("error", F.when(F.col("_date").isNull(), "PageUndated"))
    return marked.where("not _waits").select(items.columns).unionByName(found.select(items.columns))


def index_articles(items: DataFrame, pages: DataFrame, sources: DataFrame) -> DataFrame:
    """Items of index pages with title, summary and date of the article's own page; `error` PageMissing where the page was not fetched.

    The date is that of the page or, failing that, the one in the listing text; bare clocks are read in the zone of the source's region.
    """
    dim = _traits(sources).select("_s", "source_region")
    listed = items.where("error is null").join(dim, F.col("source") == F.col("_s"), "left").drop("_s")
    one = pages.select(F.col("url").alias("_url"), "body").dropDuplicates(["_url"])
    joined = listed.join(one, F.col("url") == F.col("_url"), "left").withColumn("_p", F.when(F.col("body").isNotNull(), html.page_summary(F.col("body"), _zone())))
    title = F.when(F.col("_p.title") != "", F.substring("_p.title", 1, 500)).otherwise(F.col("title"))
    text = F.when(F.col("_p.description") != "", F.col("_p.description")).otherwise(F.col("title"))
    date = F.coalesce("_p.published_us", F.unix_micros(html.page_date(F.concat(F.lit("<main>"), F.col("title"), F.lit("</main>")), _zone())))
    values = {"title": title, "summary": F.substring(text, 1, BODY_LIMIT), "published_at": _stamp(date), "error": F.when(F.col("body").isNull(), "PageMissing")}
    return joined.select(*[values.get(c, F.col(c)).alias(c) for c in items.columns]).unionByName(items.where("error is not null"))


def health(read: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, status, items): ok, partial, failed, not_modified, or disabled where nothing was fetched. Items with an error of their own make a source partial; a source outside the community without any dated item has failed."""
    item = F.col("url").isNotNull()
    sums = read.groupBy(F.col("source").alias("_s")).agg(
        F.count_if(item).alias("items"), F.count_if(item & F.col("published_at").isNotNull()).alias("dated"), F.count_if(F.col("error") == "NotModified").alias("same"), F.count_if(F.col("error").isNotNull() & (F.col("error") != "NotModified")).alias("errors")
    )
    channel = F.col("source_channel") if "source_channel" in sources.columns else F.lit("community")
    joined = sources.select("source", channel.alias("_channel")).join(sums, F.col("source") == F.col("_s"), "left")
    undated = (F.coalesce("_channel", F.lit("")) != "community") & (F.col("dated") == 0)
    status = F.when(F.col("_s").isNull(), "disabled").when((F.col("items") == 0) & (F.col("same") > 0), "not_modified").when((F.col("items") == 0) | undated, "failed").when(F.col("errors") > 0, "partial").otherwise("ok")
    return joined.select("source", status.alias("status"), F.coalesce("items", F.lit(0)).alias("items"))
