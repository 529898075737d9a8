"""Encoding of a corpus with a public byte-level BPE vocabulary by recursive queries in DuckDB.

Each partition splits its texts into words, and the distinct words not seen before become token-position rows of a DuckDB table. A
recursive query joins neighbouring tokens with the merge table and contracts each word's leftmost pair of least rank until no
pair is left; an ordered aggregation then gives each word its ids. Vocabulary and pattern come from files named by path.

Null and empty texts have no ids (an empty array). White space, control characters and any Unicode text round-trip exactly.
Words longer than LONG_WORD bytes, whose contraction by rounds is quadratic, are contracted with the same ranks by a heap of pairs (contract).
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestflow.session import cut

LONG_WORD = 2_000
CACHED_WORDS = 400_000

_RECURSION = """
WITH RECURSIVE s(w, p, t, live) AS (
  SELECT w, p, t, true FROM start
  UNION ALL
  SELECT w, p, CASE WHEN p = hit THEN merged ELSE t END, hit IS NOT NULL
  FROM (
    SELECT w, p, t, before, least_key & 4294967295 AS hit, (least_key >> 32)::INTEGER AS merged
    FROM (
      SELECT w, p, t, before, min(key) OVER (PARTITION BY w) AS least_key
      FROM (
        SELECT n.w, n.p, n.t, n.before, (m.m::BIGINT << 32) + n.p AS key
        FROM (SELECT w, p, t, lead(t) OVER o AS following, lag(p) OVER o AS before FROM s WHERE live WINDOW o AS (PARTITION BY w ORDER BY p)) n
        LEFT JOIN merges m ON m.a = n.t AND m.b = n.following)))
  WHERE hit IS NULL OR before IS NULL OR before <> hit)
SELECT w, list(t ORDER BY p) AS ids FROM s WHERE NOT live GROUP BY w ORDER BY w
"""


def default_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """(path, word pattern) of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def merge_table(path: str) -> pa.Table:
    """(a, b, m): every pair of tokens whose joined bytes are token m."""
    ranks = load_ranks(path)
    rows = []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                rows.append((a, b, rank))
    a, b, m = zip(*rows, strict=True)
    return pa.table({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "m": pa.array(m, pa.int32())})


def contract(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the leftmost pair of least rank is merged until none is left; a heap finds it, so long words cost n log n."""
    pieces: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    after = [*range(1, len(word)), -1]
    before = list(range(-1, len(word) - 1))
    heap: list[tuple[int, int, bytes]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] >= 0 and (rank := ranks.get(joined := pieces[i] + pieces[after[i]])) is not None:
            heapq.heappush(heap, (rank, i, joined))

    for i in range(len(word)):
        offer(i)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i] if pieces[i] is not None else -1
        if j < 0 or pieces[i] + pieces[j] != joined:
            continue  # one of the two was merged meanwhile
        pieces[i], pieces[j] = joined, None
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [ranks[p] for p in pieces if p is not None]


class WordEncoder:
    """Ids of words, remembered; new words of a batch are contracted together in one recursive query."""

    def __init__(self, path: str, pattern: str) -> None:
        import duckdb
        import regex

        self.ranks, self.pattern, self.path = load_ranks(path), regex.compile(pattern), path
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.connection = duckdb.connect(config={"threads": 1})
        self.connection.register("pairs", merge_table(path))
        self.connection.execute("CREATE TABLE merges AS SELECT * FROM pairs")
        self.known: dict[str, list[int]] = {}

    def _learn(self, words: list[str]) -> None:
        open_words, raw = [], []
        for word in words:
            b = word.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(b)
            if rank is not None:
                self.known[word] = [rank]
            elif len(b) > LONG_WORD:
                self.known[word] = contract(b, self.ranks)
            else:
                open_words.append(word)
                raw.append(b)
        if not raw:
            return
        sizes = np.array([len(b) for b in raw], dtype=np.int64)
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        start = pa.table({"w": np.repeat(np.arange(len(raw), dtype=np.int32), sizes), "p": (np.arange(len(flat)) - np.repeat(starts, sizes)).astype(np.int64), "t": self.byte_ids[flat]})
        self.connection.register("start", start)
        for w, ids in self.connection.execute(_RECURSION).fetchall():
            self.known[open_words[w]] = ids
        self.connection.unregister("start")

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        split = [self.pattern.findall(t) if t else [] for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        self._learn(list({w for words in split for w in words if w not in self.known}))
        known = self.known
        return [[i for w in words for i in known[w]] for words in split]


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 10_000, size: int = 64 << 20) -> Iterator[pa.RecordBatch]:
    """Batches joined to about `rows` rows, or fewer of long texts: each costs one recursive query."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows or sum(b.nbytes for b in held) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _encode(path: str, pattern: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path, pattern)
        for batch in _gathered(batches):
            ids = encoder.encode(batch.column("text").to_pylist())
            sizes = [len(x) for x in ids]
            if keep_ids:
                flat = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=sum(sizes))
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            else:
                out = pa.array(sizes, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), out], ["doc_id", "ids" if keep_ids else "tokens"])

    return run


def encode_documents(documents: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids ARRAY<INT>) of every document, without special tokens."""
    if path is None:
        path, pattern = default_vocabulary()
    return documents.select("doc_id", "text").mapInArrow(_encode(path, pattern, True), "doc_id long, ids array<int>")


def count_tokens(documents: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, tokens) of every document; null and empty texts have none."""
    if path is None:
        path, pattern = default_vocabulary()
    return documents.select("doc_id", "text").mapInArrow(_encode(path, pattern, False), "doc_id long, tokens long")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text): the bytes of the ids joined in order; an empty array gives an empty text."""
    path = path or default_vocabulary()[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = {rank: token for token, rank in load_ranks(path).items()}
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": [b"".join(pieces[i] for i in ids).decode("utf-8", "replace") for ids in batch["ids"]]})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")


def round_trip(documents: DataFrame) -> DataFrame:
    """(lang, documents, tokens, bytes, changed): sizes by language and the documents that do not decode to their text."""
    encoded = cut(encode_documents(documents), "encoded")  # used twice
    both = documents.select("doc_id", "lang", "text").join(encoded, "doc_id").join(decode_documents(encoded).withColumnRenamed("text", "decoded"), "doc_id")
    return both.groupBy("lang").agg(
        F.count("*").alias("documents"), F.sum(F.size("ids")).alias("tokens"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes"), F.count_if(F.coalesce("text", F.lit("")) != F.col("decoded")).alias("changed")
    )
