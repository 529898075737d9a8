"""Checking each new batch against everything accepted before, by page address and by title.

Pages are equal if their canonical URLs are; titles are equal but for case, spacing, punctuation, a flag in front, a site name behind and
at most one replaced or misspelt word (one term in Chinese). Both relations are turned into shared keys, so nothing is compared
pairwise: a title is a node, and titles that agree around one open slot meet under the key of that slot. Within a slot, ordinary
words may replace each other; any word without digits may differ by one slip of the pen, found by shared one-letter deletions;
numbers, versions and product names may not differ. Titles first meet by half (the first or the last half is intact), and only
halves with several titles are opened slot by slot; titles too short to halve meet by what is left beside each slot. Components of the graph of pages and titles then decide which rows are known:
those connected to history or to a row of an earlier batch.

Null or blank URLs and titles match nothing; rows without ordinal or time of discovery are left out. Rows of the same batch do not
make each other known.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Container, Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestflow.functions.urls import canonical_url
from digestflow.llm.base import bounded_keys, skip_empty
from digestflow.operators.components import connected_components
from digestflow.session import cut

MIN_ORDINARY = 1
MAX_TERM = 6  # characters of a Chinese term
SHORT_HAN = 8
MAX_SITES = 20_000
# Words that stand as a flag before a title.
FLAGS = (
    "update", "updated", "breaking", "exclusive", "just in", "live", "alert", "developing", "watch", "video", "opinion", "analysis",
    "更新", "独家", "快讯", "突发", "重磅", "最新", "视频", "首发", "原创", "转载",
)
_FLAG = re.compile(rf"^\s*(?:[\[【(（]\s*[^\]】)）]{{1,16}}[\]】)）]\s*[:：|]?\s*|(?:{'|'.join(FLAGS)})\s*[:：|｜!！]\s*)", re.I)
_TOKEN = re.compile(r"[^\W_一-鿿㐀-䶿]+|[一-鿿㐀-䶿]+")
_SEPARATOR = re.compile(r"\s*[-—–|｜_·»:：]+\s*")
_HAN = re.compile(r"[一-鿿㐀-䶿]")
_NAME_PART = re.compile(r"(?<=[^\W_])-(?=[^\W_])")


def title_tails(text: str) -> list[tuple[int, str]]:
    """(start, tail) at each separator of a title: what stands behind it, in lower case."""
    return [(m.start(), tail) for m in _SEPARATOR.finditer(text) if (tail := text[m.end() :].strip().lower())]


def title_units(title: str | None, sites: Container[str]) -> list[str]:
    """The words of a title without flag and site name, in lower case; Chinese runs stay whole."""
    text = unicodedata.normalize("NFKC", title or "")
    text = _FLAG.sub("", text, count=1)
    text = next((text[:start] for start, tail in title_tails(text) if tail in sites), text)
    return _TOKEN.findall(text.lower())


def _h(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(parts)) - (1 << 63)


def _normalise(sites: object):
    """sites: a broadcast set of names, or None where each row brings its own in `_sites`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [sites.value] * len(batch) if sites is not None else batch["_sites"]
            units = [title_units(t, known) for t, known in zip(batch["title"], own, strict=True)]
            yield pd.DataFrame({"ordinal": batch["ordinal"], "day": batch["day"], "url_node": batch["url_node"], "title_node": pd.array([_h("t", "".join(u)) if u else None for u in units], dtype="Int64"), "units": [" ".join(u) for u in units], "plain": batch["title"].astype(object)})

    return run


@skip_empty
def _all_tails(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = {(title, tail) for title in batch["title"] for _, tail in title_tails(_FLAG.sub("", unicodedata.normalize("NFKC", title or ""), count=1))}
        yield pd.DataFrame(list(rows), columns=["_t", "tail"])


def normalised(rows: DataFrame, sites: DataFrame, limit: int = MAX_SITES) -> DataFrame:
    """rows(ordinal, day, url_node, title) with title_node, units and plain. sites(name): names that may stand behind a title; few are broadcast, many are joined."""
    names = bounded_keys(sites.select("name"), limit)
    schema = "ordinal long, day long, url_node long, title_node long, units string, plain string"
    if names is not None:
        shared = rows.sparkSession.sparkContext.broadcast(frozenset(names))
        return rows.mapInPandas(_normalise(shared), schema)
    tails = rows.select("title").mapInPandas(_all_tails, "_t string, tail string").join(sites, F.col("tail") == F.col("name"), "left_semi")
    own = tails.groupBy("_t").agg(F.collect_set("tail").alias("_sites"))
    joined = rows.join(own, F.col("title") == F.col("_t"), "left").withColumn("_sites", F.coalesce("_sites", F.array().cast("array<string>")))
    return joined.select("ordinal", "day", "url_node", "title", "_sites").mapInPandas(_normalise(None), schema)


def _deletions(word: str) -> set[str]:
    """A word without digits of four letters or more, and its one-letter deletions: two words that share one differ by a slip of the pen."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))} if len(word) >= 4 and not any(c.isdigit() for c in word) else set()


def _spans(solid: str, longest: int) -> Iterator[tuple[int, int]]:
    """The places of a Chinese term that may be replaced: no letters or digits inside, something left outside."""
    for i in range(len(solid)):
        for k in range(i + 1, min(i + longest, len(solid)) + 1):
            if not _HAN.match(solid[k - 1]):
                break
            if k - i < len(solid):
                yield i, k


@skip_empty
def _halves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keys for each title: what is left of it when the slot lies in its last or first half; for a Chinese term, at each length it may have."""
    for batch in batches:
        out = []
        for node, units in zip(batch["title_node"], batch["units"], strict=True):
            words = units.split(" ")
            if _HAN.search(units):
                solid, middle = "".join(words), len(words) // 2
                if len(solid) < SHORT_HAN:  # too short to halve: what is left around each term
                    out += [(_h("h3", solid[:i], solid[k:]), node) for i, k in _spans(solid, MAX_TERM)]
                    out += [(_h("h4", str(len(words)), str(i), *words[:i], *words[i + 1 :]), node) for i in range(len(words)) if len(words) > 1]
                else:
                    # two titles have the same rest beside their terms, whatever the terms' lengths; half of it lies on one side
                    for half in {(len(solid) - term + 1) // 2 for term in range(1, MAX_TERM + 1)}:
                        out += [(_h("h", solid[:half]), node), (_h("h2", solid[-half:]), node)]
                    if len(words) > 1:
                        out += [(_h("e1", str(len(words)), *words[:middle]), node), (_h("e2", str(len(words)), *words[middle:]), node)]
            elif len(words) >= 4:
                half = len(words) // 2
                out += [(_h("e1", str(len(words)), *words[:half]), node), (_h("e2", str(len(words)), *words[half:]), node)]
            elif len(words) > 1:
                out += [(_h("e3", str(len(words)), str(i), *words[:i], *words[i + 1 :]), node) for i in range(len(words))]
            else:
                out += [(_h("e4", v), node) for v in _deletions(words[0])]
        yield pd.DataFrame(out, columns=["half", "title_node"]).astype("int64").drop_duplicates()


@skip_empty
def _slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(slot, word, title_node): a title with one word, or one Chinese term, left open."""
    for batch in batches:
        out = []
        for node, units in zip(batch["title_node"], batch["units"], strict=True):
            words = units.split(" ")
            chinese = _HAN.search(units) is not None
            if len(words) == 1 and not chinese:  # nothing is left beside the only word: it may be misspelt, not replaced
                out += [(_h("s1", v), "", node) for v in _deletions(words[0])]
                continue
            for i, w in enumerate(words):
                if not _HAN.match(w):
                    out.append((_h("s", str(len(words)), str(i), *words[:i], *words[i + 1 :]), w, node))
            if chinese:
                solid = "".join(words)
                out += [(_h("z", solid[:i], solid[k:]), "", node) for i, k in _spans(solid, MAX_TERM)]
        yield pd.DataFrame(out, columns=["slot", "word", "title_node"]).astype({"slot": "int64", "title_node": "int64"})


@skip_empty
def _slips(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keys under which the words of a slot meet: one for ordinary words, and the one-letter deletions of words without digits."""
    for batch in batches:
        out = []
        for slot, word, ordinary, node in zip(batch["slot"], batch["word"], batch["ordinary"], batch["title_node"], strict=True):
            if ordinary or not word:
                out.append((_h("o", str(slot)), node))
            out += [(_h("d", str(slot), v), node) for v in _deletions(word)]
        yield pd.DataFrame(out, columns=["key", "title_node"]).astype("int64")


@skip_empty
def _word_uses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How often each word stands alone in lower case, and how often at all, in titles of mixed case."""
    for batch in batches:
        alone: dict[str, int] = {}
        total: dict[str, int] = {}
        for title in batch["plain"]:
            text = unicodedata.normalize("NFKC", title or "")
            if text == text.lower() or text == text.upper():
                continue  # such a title does not tell names from words
            for m in re.finditer(r"[^\W\d_一-鿿㐀-䶿]+", text):
                word, low = m[0], m[0].lower()
                total[low] = total.get(low, 0) + 1
                beside = text[max(0, m.start() - 1) : m.start()] + text[m.end() : m.end() + 1]
                if word == low and "-" not in beside:
                    alone[low] = alone.get(low, 0) + 1
        yield pd.DataFrame({"word": list(total), "alone": [alone.get(w, 0) for w in total], "total": list(total.values())})


def ordinary_words(titles: DataFrame) -> DataFrame:
    """(word): ordinary words, seen in lower case by themselves in at least half of their uses in titles(plain)."""
    uses = titles.select("plain").mapInPandas(_word_uses, "word string, alone long, total long").groupBy("word").agg(F.sum("alone").alias("alone"), F.sum("total").alias("total"))
    return uses.where((F.col("alone") >= MIN_ORDINARY) & (F.col("alone") * 2 >= F.col("total"))).select("word")


def half_keys(titles: DataFrame) -> DataFrame:
    """(half, title_node) of titles(title_node, units): two matching titles share a half."""
    return titles.select("title_node", "units").mapInPandas(_halves, "half long, title_node long")


def match_keys(titles: DataFrame, ordinary: DataFrame | None = None, halved: bool = True) -> DataFrame:
    """titles(title_node, units, plain), one row per node, to (key, title_node), written: two titles match if they share a key.

    ordinary(word): the ordinary words, by default those of the titles. halved: whether titles that share no half are left aside first.
    A slot or key of many titles is folded to its least title on the map side before anything is moved.
    """
    opened = titles
    if halved:
        halves = half_keys(titles)
        shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
        opened = titles.join(halves.join(shared, "half", "left_semi").select("title_node").distinct(), "title_node", "left_semi")
    slots = cut(opened.select("title_node", "units").mapInPandas(_slots, "slot long, word string, title_node long"), "slots")
    full = slots.groupBy("slot").agg(F.min("title_node").alias("_lo"), F.max("title_node").alias("_hi")).where("_lo <> _hi").select("slot")
    known = (ordinary_words(titles) if ordinary is None else ordinary).select("word", F.lit(True).alias("ordinary"))
    worded = slots.join(full, "slot", "left_semi").join(known, "word", "left").select("slot", "word", F.coalesce("ordinary", F.lit(False)).alias("ordinary"), "title_node")
    return cut(worded.mapInPandas(_slips, "key long, title_node long"), "keyed")


def title_links(titles: DataFrame, ordinary: DataFrame | None = None, halved: bool = True) -> DataFrame:
    """titles as in match_keys to (a, b): links whose components join all matching titles, each title of a key to the least one."""
    keyed = match_keys(titles, ordinary, halved)
    least = keyed.groupBy("key").agg(F.min("title_node").alias("b"), F.max("title_node").alias("_hi")).where("b <> _hi").select("key", "b")
    return keyed.join(least, "key").where("title_node <> b").select(F.col("title_node").alias("a"), "b").distinct()


def matching_titles(titles: DataFrame, asked: DataFrame) -> DataFrame:
    """(id, neighbour): all titles that match a title of asked(title_node), a bounded query set."""
    keyed = match_keys(titles)
    mine = keyed.join(asked.select("title_node").distinct(), "title_node", "left_semi").select("key", F.col("title_node").alias("id"))
    return mine.join(keyed, "key").where("id <> title_node").select("id", F.col("title_node").alias("neighbour")).distinct()


def url_node(url: Column) -> Column:
    """Node of a page; null for a null or blank URL."""
    return F.when(F.trim(url) != "", F.xxhash64(F.lit("u"), canonical_url(url)))


def rows_of(items: DataFrame) -> DataFrame:
    """items(ordinal, url, title, discovered_at) as rows (ordinal, day, url_node, title), url_node 0 for none."""
    day = F.datediff(F.col("discovered_at").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return items.where("ordinal is not null and discovered_at is not null").select("ordinal", day.alias("day"), F.coalesce(url_node(F.col("url")), F.lit(0)).alias("url_node"), "title")


def site_names(sources: DataFrame) -> DataFrame:
    """(name): the display names that may stand behind a title, in lower case."""
    return sources.where("trim(display_name) <> ''").select(F.lower(F.trim("display_name")).alias("name")).distinct()


def known_rows(items: DataFrame, history_urls: DataFrame, history_titles: DataFrame, sites: DataFrame, ordinary: DataFrame | None = None) -> DataFrame:
    """(ordinal) of items(ordinal, url, title, discovered_at) connected to history or to a row of an earlier batch (UTC date)."""
    past = history_titles.select(F.lit(-1).cast("long").alias("ordinal"), F.lit(-1).cast("long").alias("day"), F.lit(0).cast("long").alias("url_node"), "title")
    both = cut(normalised(rows_of(items).unionByName(past), sites).withColumn("url_node", F.nullif("url_node", F.lit(0).cast("long"))), "titles")
    titles = both.where("title_node is not null").groupBy("title_node").agg(F.min("units").alias("units"), F.min("plain").alias("plain"))
    linked = cut(title_links(titles, ordinary), "links")
    urls_past = history_urls.select(url_node(F.col("url")).alias("node"), F.lit(-1).cast("long").alias("day")).where("node is not null")
    edges = both.where("ordinal >= 0 and url_node is not null and title_node is not null").select(F.col("url_node").alias("a"), F.col("title_node").alias("b")).distinct()
    # an edge whose two ends meet nothing else is a component already
    by_url = edges.groupBy("a").agg(F.count("*").alias("_u"))
    by_title = edges.groupBy("b").agg(F.count("*").alias("_t"))
    ends = linked.select(F.col("a").alias("b")).unionByName(linked.select("b")).distinct().withColumn("_l", F.lit(True))
    marked = cut(edges.join(by_url, "a").join(by_title, "b").join(ends, "b", "left").withColumn("busy", (F.col("_u") > 1) | (F.col("_t") > 1) | F.coalesce("_l", F.lit(False))).select("a", "b", "busy"), "edges")
    components = connected_components(marked.where("busy").select("a", "b").unionByName(linked))
    components = components.unionByName(marked.where("not busy").select(F.col("a").alias("node"), F.col("b").alias("component")))
    dated = both.select("ordinal", "day", F.coalesce("title_node", "url_node").alias("node")).unionByName(urls_past.select(F.lit(-1).cast("long").alias("ordinal"), "day", "node")).where("node is not null")
    placed = cut(dated.join(components, "node", "left").select("ordinal", "day", F.coalesce("component", "node").alias("component")), "placed")
    first = placed.groupBy("component").agg(F.min("day").alias("first"))
    return placed.where("ordinal >= 0").join(first, "component").where("first < day").select("ordinal")
