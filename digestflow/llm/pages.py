"""Main body of each page by site style trees.

Every summary is a page and its lines are the element nodes below the page's root. A line has a presentation style told from its shape
alone (item, numbered, heading before numbered lines, label, menu of short phrases, prose) and content below it: the label, the phrases or words of a
menu, the sentences of a line of prose with one slot left open in short ones, a long paragraph as a whole. The pages of one host are merged into that host's tree, and the trees of
all hosts into one forest with each host's own name replaced.

* Content importance of a leaf: one minus the entropy of its spread over the m pages that show its style, 1 - ln(c) / ln(m) for a leaf on
  c pages. A host's own tree decides where the leaf stands on at least FLOOR pages of it, the forest as well; the lesser importance counts.
* Presentation importance of a style node: the entropy of its shapes (numbers of phrases, lengths of sentences) to base m: prose takes
  nearly as many shapes as it has lines, a list of links takes few.
* Composite importance of a line: both, weighted by GAMMA. A branch is removed if it and all leaves below it (in a menu their mean) are below the threshold.

Pages are told apart by the story they carry (the longest name in the title), so copies of one story count once. Two things are fixed by the
problem's statement and not left to importance: lines repeated within a source (lines.py) are outside the main body, and list
items and closing lines (tags, link to the notes, desk signature, part number) belong to it.

Null and empty summaries have an empty body. Two passes: one gathers counts, one marks lines; no text is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestflow.llm import lines
from digestflow.llm.base import skip_empty
from digestflow.session import cut

IMPORTANCE, GAMMA = 0.82, 0.9
FLOOR = 6
LONG, PLAIN = 200, 60
PHRASE, HAN_PHRASE = 42, 7
MAX_BROADCAST_FEATURES = 300_000
BODIES = "ordinal long, source string, title string, summary string, dropped array<int>, body string"

_TERMINAL = re.compile(r"[.!?。！？][\"'”’」』)）»]*\s*\Z")
_ITEM = re.compile(r"^\s*[-–]\s+\S")
_NUMBERED = re.compile(r"^\s*\d+[.、)]\s*\S")
_LABEL = re.compile(r"^\W*([^\W_](?:[^:：。！？!?]{0,34}[^\s:：。！？!?])?)\s?[:：](?!//)\s*\S")
# Fixed by the problem's statement: closing lines that are main body.
_CLOSING = re.compile(
    r"\s*(?:(?:tags?|topics?|keywords?|标签|关键词)\s*[:：]|(?:full notes|全文|详情见|完整说明)\s*[:：]?\s*https?:|[—–-]{1,2}\s*(?:the\s.{1,60}\sdesk|.{1,30}编辑部)\s*$)",
    re.I,
)
_PART = re.compile(r"[(（](?:part|第)\s*\d+\s*(?:部分|篇|期|章|节)?[)）]\s*$", re.I)
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])")
_PHRASE_END = re.compile(r"\s*[|·>/»•,、]\s*|\s{2,}|\s*　\s*|(?<=[.!?])\s+|(?<=[。！？])")
_HAN_PHRASE_END = re.compile(_PHRASE_END.pattern + r"|\s")
_WORDS = re.compile(r"[^\W_]+(?:[-'’][^\W_]+)*")
_LETTER = re.compile(r"[^\W_]")
_DIGITS = re.compile(r"\d+")
_NINES = re.compile(r"9+")
_ASCII_END = re.compile(r"[.!?]\s+")
_NOT_TITLE = re.compile(r"[^\w\s'’-]")
_BREAKS = re.compile(r"[\W_]+")
_NAME = re.compile(r"[A-Z][^\W\d_]{4,}")
_HAN = re.compile(r"[㐀-䶿一-鿿]")
_DAY = re.compile(r"\b(?:mon|tue|wed|thu|fri|sat|sun)(?:s|nes|rs|ur)?(?:day)?\b|(?<=周)[一二三四五六日天]")


def is_item(line: str) -> bool:
    """A list item of the main body."""
    return _ITEM.match(line) is not None


def is_closing(line: str) -> bool:
    """A closing line of the main body: tags, a link to the notes, a desk signature or a part number."""
    return _CLOSING.match(line) is not None or (line.rstrip().endswith((")", "）")) and _PART.search(line) is not None)


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(parts)) - (1 << 63)


def _story(title: str | None) -> int:
    names = _NAME.findall(title or "") or _WORDS.findall((title or "").lower())
    return _hash(max(names, key=len).lower() if names else "")


# ASCII lines, most of all, are told by bytes: words in lower case with each digit as 9; a line of what can end a phrase.
_FOLDED = bytes(57 if chr(c).isdigit() else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(128)) + bytes(128)
_DAYS = frozenset(d + m + e for d in ("mon", "tue", "wed", "thu", "fri", "sat", "sun") for m in ("", "s", "nes", "rs", "ur") for e in ("", "day"))
_ENDS = bytes(10 if chr(c) in "|>/,.!?" or (chr(c).isspace() and c != 32) else c for c in range(128)) + bytes(128)
_ASCII_DIGITS = b"0123456789"


def _wide(text: str) -> bool:
    """Whether an ASCII text surely has a phrase of more than PHRASE characters; a few such texts are not told."""
    if len(text) <= PHRASE or "  " in text:
        return False
    return any(len(p) > PHRASE and len(p.strip()) > PHRASE and p.upper() != p.lower() for p in text.encode("ascii").translate(_ENDS, _ASCII_DIGITS).split(b"\n"))


def _sentences(text: str, ascii: bool) -> list[str]:
    if not ascii and ("。" in text or "！" in text or "？" in text):
        return [s for s in _SENTENCE_END.split(text) if s]
    start, out = 0, []
    for end in _ASCII_END.finditer(text):
        out.append(text[start : end.start() + 1])
        start = end.end()
    if start < len(text):
        out.append(text[start:])
    return out


def _plain(text: str, site: str) -> str:
    """Words in lower case with numbers, weekdays and the host's own name replaced."""
    if text.isascii():
        words = text.encode("ascii").translate(_FOLDED).decode("ascii").split()
        short = " ".join(words)
        if "99" in short:
            short = _NINES.sub("9", short)
        if site and site in short:
            return _DAY.sub("9", short.replace(site, "@"))
        return short if _DAYS.isdisjoint(words) else " ".join(["9" if w in _DAYS else w for w in short.split()])
    text = _BREAKS.sub(" ", _DIGITS.sub("9", text.lower())).strip()
    return _DAY.sub("9", text.replace(site, "@") if site else text)


def _templates(text: str, han: bool) -> list[str]:
    """A short sentence and its forms with one slot open."""
    if han:
        return [text] if len(text) > 18 else [text, f"{text[:2]}*{text[-6:]}"]
    words = text.split()
    return [text, *(" ".join([*words[:i], "*", *words[i + 1 :]]) for i in range(len(words) - 1))] if 4 < len(words) <= 10 else [text]


def _node(line: str, following: str | None, site: str) -> tuple[str, str, list[list[str]]]:
    """(style, shape, leaves) of a line; each leaf is given by its content features, of which the least important counts. Items and closing lines have no leaves."""
    text = line.strip()
    if len(line) > LONG:
        return "prose", str(len(text) >> 3), [[text.lower()]]
    if is_item(line) or is_closing(line):
        return "kept", "", []
    if _NUMBERED.match(line):
        return "numbered", str(text.count(" ")), [["9."]]
    terminal = _TERMINAL.search(text[-6:]) is not None
    ascii = text.isascii()
    han = not ascii and _HAN.search(line) is not None
    if not terminal:
        if following is not None and _NUMBERED.match(following):
            return "heading", str(text.count(" ")), [["9."]]
        if label := _LABEL.match(line):
            return "label", str(text.count(" ")), [[_DIGITS.sub("9", label[1].lower())]]
    if not (ascii and _wide(text)):
        phrases = [p for p in (_HAN_PHRASE_END if han else _PHRASE_END).split(_DIGITS.sub("9", text)) if _LETTER.search(p)]
        if len(phrases) >= 2 and (not terminal or len(phrases) >= 3) and all(len(p) <= (HAN_PHRASE if han else PHRASE) for p in phrases):
            words = [_plain(p, site) for p in phrases] if han else _plain(text, site).split()
            return "menu", str(len(phrases)), [[w] for w in words]
    if not terminal and not han and not _NOT_TITLE.search(text):
        words = _WORDS.findall(line)
        if 2 <= len(words) <= 14 and all(w[0].isupper() for w in words):
            return "menu", str(len(words)), [[w.lower()] for w in words]
    sentences = _sentences(text, ascii)
    shape = " ".join([str(len(s) >> 3) for s in sentences])
    if terminal and len(line) > PLAIN:
        leaves = [[s.lower() if len(s) > PLAIN else _plain(s, site)] for s in sentences]
    elif len(sentences) == 1:
        whole = terminal and (len(text) > 12 if han else len(_WORDS.findall(line)) > 6)
        leaves = [[_plain(text, site)] if whole else _templates(_plain(text, site), han)]
    else:
        leaves = [[_plain(s, site)] for s in sentences]
        if not terminal and following is not None:
            # an open line inside a page: a notice with its button; only the notice's first words are always the same
            head = leaves[0][0][:4] if han else " ".join(leaves[0][0].split()[:3])
            leaves[0].append(f"{head} *")
    return "prose", shape, leaves


def _site(name: str | None) -> str:
    return re.sub(r"[\W_]+", " ", (name or "").lower()).strip()


_ASCII_OTHER = bytes(c for c in range(128) if not chr(c).isalpha())
_LOWER = bytes(range(128)).lower() + bytes(range(128, 256))
_NO_LETTERS = re.compile(r"[\W\d_]+")


def _line_key(source: str | None, line: str) -> int | None:
    """Identifier of a line within its source: the hash of its letters; None without letters."""
    letters = line.encode("utf-8", "surrogatepass").translate(_LOWER, _ASCII_OTHER)
    if not letters.isascii():
        letters = _NO_LETTERS.sub("", letters.decode("utf-8", "surrogatepass").lower()).encode("utf-8")
    return xxhash.xxh64_intdigest(b"line\x1f%b\x1f%b" % ((source or "").encode("utf-8"), letters)) - (1 << 63) if letters else None


def _prepare(records: DataFrame, sources: DataFrame | None) -> DataFrame:
    if sources is None:
        return records.withColumn("_site", F.lit(""))
    names = sources.select(F.col("source").alias("_s"), F.col("display_name").alias("_site")).where("_s is not null").dropDuplicates(["_s"])
    return records.join(names, F.col("source") == F.col("_s"), "left").drop("_s")


def _walk(summary: str | None) -> Iterator[tuple[int, str, str | None]]:
    """(line number, line, next non-blank line) of the lines that are not blank."""
    if not summary:
        return
    rows = summary.split("\n")
    following: list[str | None] = [None] * len(rows)
    after = None
    for i in range(len(rows) - 1, -1, -1):
        following[i] = after
        after = rows[i] if rows[i].strip() else after
    for i, line in enumerate(rows):
        if line.strip():
            yield i + 1, line, following[i]


@skip_empty
def _count_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (style, feature, host, story, n): a leaf on the page of a story; a shape (`~style`) n times; a line (`line`) of a host in n documents; a host (`size`) of n documents."""
    for batch in batches:
        seen: set[tuple[str, int, int, int]] = set()
        held: dict[tuple[str, int, int, int], int] = {}
        for source, title, summary, site, counted in zip(batch["source"], batch["title"], batch["summary"], batch["_site"], batch["counted"], strict=True):
            story, site, host = _story(title), _site(site), _hash("source", source or "")
            keys = set()
            for _, line, following in _walk(summary):
                keys.add(_line_key(source, line))
                style, shape, leaves = _node(line, following, site)
                if leaves:
                    seen.update((style, _hash(style, f), host, story) for leaf in leaves for f in leaf)
                    row = (f"~{style}", _hash(shape), 0, 0)
                    held[row] = held.get(row, 0) + 1
            if counted:
                keys.discard(None)
                for row in [("size", host, host, 0), *(("line", k, host, 0) for k in keys)]:
                    held[row] = held.get(row, 0) + 1
        keys = [*seen, *held]
        style, *numbers = zip(*keys, strict=True) if keys else ((), (), (), ())
        counts = np.concatenate([np.ones(len(seen), dtype=np.int64), np.fromiter(held.values(), dtype=np.int64, count=len(held))])
        columns = {name: np.array(values, dtype=np.int64) for name, values in zip(("feature", "host", "story"), numbers, strict=True)}
        yield pd.DataFrame({"style": np.array(style, dtype=object), **columns, "n": counts})


def _own_key(feature: int, host: int) -> int:
    """Key of a leaf in its host's own tree; SQL has the same below."""
    return feature ^ (host >> 1)


def style_tree(prepared: DataFrame, min_rows: int = lines.MIN_ROWS, min_share: float = lines.MIN_SHARE) -> DataFrame:
    """(style, key, importance) of the nodes of all trees: leaves of the forest, leaves of hosts, styles; a line repeated within its source has importance 0."""
    counted = prepared.select("source", "title", "summary", "_site", "counted").mapInPandas(_count_features, "style string, feature long, host long, story long, n long")
    spread = cut(counted.groupBy("style", "feature", "host", "story").agg(F.sum("n").alias("n")), "features")
    content = spread.where(~F.col("style").isin("line", "size") & ~F.col("style").startswith("~"))
    entropy = F.lit(1.0) - F.log("pages") / F.log(F.greatest(F.col("all_pages"), F.lit(2)))
    leaves = content.select("style", "feature", "story").distinct().groupBy("style", "feature").agg(F.count("*").alias("pages")).where(F.col("pages") > F.when(F.col("style") == "prose", 2).otherwise(1))  # prose of two stories may be a copy
    styles = content.select("style", "story").distinct().groupBy("style").agg(F.count("*").alias("all_pages"))
    forest = leaves.join(F.broadcast(styles), "style").select("style", F.col("feature").alias("key"), entropy.alias("importance"))  # five styles
    own = content.groupBy("style", "feature", "host").agg(F.count("*").alias("pages")).where(F.col("pages") >= FLOOR)
    hosts = content.select("style", "host", "story").distinct().groupBy("style", "host").agg(F.count("*").alias("all_pages"))
    trees = own.join(hosts, ["style", "host"]).select("style", F.col("feature").bitwiseXOR(F.shiftright("host", 1)).alias("key"), entropy.alias("importance"))
    shapes = spread.where(F.col("style").startswith("~")).groupBy("style").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"))
    presented = shapes.select("style", F.xxhash64("style").alias("key"), ((F.log("m") - F.col("s") / F.col("m")) / F.log(F.greatest(F.col("m"), F.lit(2)))).alias("importance"))
    sizes = spread.where("style = 'size'").select("host", F.col("n").alias("rows"))
    repeated = spread.where((F.col("style") == "line") & (F.col("n") >= min_rows)).join(sizes, "host").where(F.col("n") >= F.lit(min_share) * F.col("rows"))
    return forest.unionByName(trees).unionByName(presented).unionByName(repeated.select("style", F.col("feature").alias("key"), F.lit(0.0).alias("importance")))


def _is_noise(style: str, leaves: list[list[str]], host: int, known: dict[int, float], presented: dict[str, float], threshold: float) -> bool:
    """Whether a line and everything below it is of low importance."""
    values, shown = [], (1.0 - GAMMA) * presented.get(style, 1.0)
    alone = style != "menu" and shown + GAMMA >= threshold  # one leaf of full importance decides
    for leaf in leaves:
        least = 1.0
        for f in leaf:
            k = _hash(style, f)
            least = min(least, known.get(k, 1.0), known.get(_own_key(k, host), 1.0))
        if alone and least >= 1.0:
            return False
        values.append(least)
    content = sum(values) / len(values) if style == "menu" else max(values)
    return shown + GAMMA * content < threshold


def _mark(shared: object, presented: dict[str, float], threshold: float, then: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None):
    """Function for mapInPandas adding `dropped` (line numbers) and `body` to each record; and what is to follow."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = dict(zip(*(a.tolist() for a in shared.value), strict=True)) if shared is not None else None
        for batch in batches:
            own = [known] * len(batch) if known is not None else ({f["key"]: f["importance"] for f in row} for row in batch["_known"])
            dropped, bodies = [], []
            for source, summary, site, mine in zip(batch["source"], batch["summary"], batch["_site"], own, strict=True):
                bad = set()
                site, host = _site(site), _hash("source", source or "")
                for number, line, following in _walk(summary):
                    if _line_key(source, line) in mine:
                        bad.add(number)
                        continue
                    style, _, leaves = _node(line, following, site)
                    if leaves and _is_noise(style, leaves, host, mine, presented, threshold):
                        bad.add(number)
                dropped.append(sorted(bad))
                bodies.append("\n".join(r for n, r in enumerate(summary.split("\n"), 1) if n not in bad) if bad else summary or "")
            out = batch[["ordinal", "source", "title", "summary"]].astype(object)
            out["dropped"], out["body"] = dropped, bodies
            yield out

    return run if then is None else lambda batches: then(run(batches))


@skip_empty
def _own_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for ordinal, source, summary, site in zip(batch["ordinal"], batch["source"], batch["summary"], batch["_site"], strict=True):
            site, host = _site(site), _hash("source", source or "")
            own = {_line_key(source, line) for _, line, _ in _walk(summary)} - {None}
            for _, line, following in _walk(summary):
                style, _, leaves = _node(line, following, site)
                own.update(k for leaf in leaves for f in leaf for h in [_hash(style, f)] for k in (h, _own_key(h, host)))
            out += [(ordinal, f) for f in own]
        yield pd.DataFrame(out, columns=["_o", "key"]).astype({"_o": "int64", "key": "int64"})


def main_bodies(records: DataFrame, sources: DataFrame | None = None, counted: Column | None = None, importance: float = IMPORTANCE, broadcast_limit: int = MAX_BROADCAST_FEATURES, then: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None, schema: str = BODIES) -> DataFrame:
    """records(ordinal, source, title, summary) with `dropped` ARRAY<INT> (numbers of the removed lines) and `body`.

    then: makes rows of `schema` of these in the same batches, so that no text goes through Spark once more.
    counted: whether a record counts when lines repeated within a source are sought; all do by default. Records without ordinal give no row.
    """
    told = records.where("ordinal is not null").select("ordinal", "source", "title", "summary", (F.lit(True) if counted is None else counted).alias("counted"))
    prepared = _prepare(told, sources)
    tree = cut(style_tree(prepared), "tree")
    presented = {style[1:]: value for style, value in tree.where(F.col("style").startswith("~")).select("style", "importance").collect()}  # five styles
    # a leaf that cannot bring its line below the threshold need not be known
    low = tree.where(~F.col("style").startswith("~") & (F.col("importance") < importance / GAMMA)).groupBy("key").agg(F.min("importance").alias("importance"))
    rows = low.limit(broadcast_limit + 1).toPandas()
    if len(rows) <= broadcast_limit:
        shared = records.sparkSession.sparkContext.broadcast((rows["key"].to_numpy(dtype="int64"), rows["importance"].to_numpy(dtype="float64")))
        return prepared.mapInPandas(_mark(shared, presented, importance, then), schema)
    own = prepared.mapInPandas(_own_features, "_o long, key long").join(low, "key").groupBy("_o").agg(F.collect_list(F.struct("key", "importance")).alias("_known"))
    joined = prepared.join(own, F.col("ordinal") == F.col("_o"), "left").drop("_o").withColumn("_known", F.coalesce("_known", F.expr("array()").cast("array<struct<key: bigint, importance: double>>")))
    return joined.mapInPandas(_mark(None, presented, importance, then), schema)


def removed_lines(records: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """(ordinal, line_no) of every non-blank line outside the main body."""
    return main_bodies(records, sources).select("ordinal", F.explode(F.col("dropped").cast("array<bigint>")).alias("line_no"))
