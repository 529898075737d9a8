"""Candidates of an exact set-similarity join: prefix filter over rare tokens, then a lossless bitmap bound.

Two sets of Jaccard at least t share an element among the first n - ceil(t n) + 1 of each in any common order, so rows meet only under the tokens of
these prefixes. The order puts rare tokens first: frequencies come from one aggregation into a count sketch of fixed size, and a token
whose slot counts one row has no partner at all. Rows of one token and time bucket are compared where they lie by 256-bit bitmaps: the bits in which
two bitmaps differ are at most the elements in which the sets differ, so (|a| + |b| - differing bits) / 2 bounds the overlap from above, and a
pair below the overlap it needs is dropped for good.

The rows of a token and bucket beyond BLOCK stream through into packed blocks, and each pair of blocks is one row of work for some task; a token of more
than SALTED rows is spread over several tasks by a salt before. No task holds an unbounded token, and only pairs that pass the bound are written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestflow.operators import windowjoin
from digestflow.session import cut

BLOCK = 1_000
SALTED = 256 * BLOCK
WORDS = 4
SLOTS = 1 << 16
_HASH = np.uint64(0x9E3779B97F4A7C15)
_POSTING = "key long, salt int, salts int, role int, ordinal long, at long, size int, b0 long, b1 long, b2 long, b3 long"
_FOUND = "a long, b long, key long, salt int, n0 int, rows binary"


def _hashed(rows: DataFrame, grouped: bool) -> DataFrame:
    group = F.xxhash64("group") if grouped else F.lit(0).cast("long")
    return rows.where("size(tokens) > 0 and ordinal is not null and at is not null").select("ordinal", "at", group.alias("group"), F.transform("tokens", lambda t: F.xxhash64(t)).alias("hashes"))


def frequencies(rows: DataFrame) -> np.ndarray:
    """How many (row, token) pairs fall into each of SLOTS slots of token hashes; rows(hashes)."""
    slots = rows.select(F.explode(F.transform("hashes", lambda h: F.pmod(h, F.lit(SLOTS)).cast("int"))).alias("slot")).groupBy("slot").agg(F.count("*").alias("n")).toPandas()
    out = np.zeros(SLOTS, dtype=np.int64)
    out[slots["slot"].to_numpy(dtype=np.int64)] = slots["n"].to_numpy(dtype=np.int64)
    return out


def _postings(shared: object, jaccard: float, window: int | None, role: int | None):
    """Each row under every token of its prefix. role None: a self-join, each row at home in its time bucket (0) and a guest in the next (1); else the side of the row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = shared.value
        for batch in batches:
            sizes = batch["hashes"].map(len).to_numpy(dtype=np.int64)
            if not len(sizes):
                continue
            flat = np.concatenate([np.asarray(h, dtype=np.int64) for h in batch["hashes"]])
            owner = np.repeat(np.arange(len(sizes)), sizes)
            bits = np.zeros((len(sizes), WORDS), dtype=np.uint64)
            wide = flat.view(np.uint64)
            np.bitwise_or.at(bits, (owner, ((wide >> np.uint64(6)) % np.uint64(WORDS)).astype(np.int64)), np.uint64(1) << (wide & np.uint64(63)))
            often = counts[flat % SLOTS]
            order = np.lexsort((flat, often, owner))
            rank = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            prefix = sizes - np.ceil(jaccard * sizes - 1e-9).astype(np.int64) + 1
            kept = order[(rank < prefix[owner[order]]) & (often[order] > 1)]
            own, token, salts = owner[kept], flat[kept].view(np.uint64), np.maximum(1, -(-often[kept] // SALTED))
            at, group = batch["at"].to_numpy(dtype=np.int64)[own], batch["group"].to_numpy(dtype=np.int64)[own].view(np.uint64)
            ordinal = batch["ordinal"].to_numpy(dtype=np.int64)[own]
            signed = bits.view(np.int64)[own]
            for step, r in ((0, 0), (1, 1)) if role is None else ((0, role),):
                time = (at // window + step).astype(np.uint64) if window is not None else np.uint64(0)
                key = ((token ^ (group * _HASH)) * _HASH + time * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)
                yield pd.DataFrame({"key": key, "salt": (ordinal % salts).astype(np.int32), "salts": salts.astype(np.int32), "role": np.int32(r), "ordinal": ordinal, "at": at, "size": sizes[own].astype(np.int32), "b0": signed[:, 0], "b1": signed[:, 1], "b2": signed[:, 2], "b3": signed[:, 3]})

    return run


class Rows:
    """Posting rows as arrays."""

    def __init__(self, frame: pd.DataFrame) -> None:
        self.role, self.ids, self.at = frame["role"].to_numpy(dtype=np.int32), frame["ordinal"].to_numpy(dtype=np.int64), frame["at"].to_numpy(dtype=np.int64)
        self.sizes, self.bits = frame["size"].to_numpy(dtype=np.int32), frame[["b0", "b1", "b2", "b3"]].to_numpy(dtype=np.int64).view(np.uint64)

    def passing(self, i: np.ndarray, other: Rows, j: np.ndarray, jaccard: float, containment: float, window: int | None, mirrored: bool) -> np.ndarray:
        """Which of the pairs (i of these rows, j of the others) may have the overlap they need."""
        hit = (self.role[i] == 0) | (other.role[j] == 0) if mirrored else self.role[i] != other.role[j]
        hit &= self.ids[i] != other.ids[j] if mirrored else True
        if window is not None:
            hit &= np.abs(self.at[i] - other.at[j]) <= window
        differing = np.bitwise_count(self.bits[i] ^ other.bits[j]).sum(axis=1, dtype=np.int32)
        both = self.sizes[i] + other.sizes[j]
        needed = np.maximum(containment * np.minimum(self.sizes[i], other.sizes[j]), jaccard / (1 + jaccard) * both)
        return hit & (both - differing >= 2 * needed - 1e-6)

    def pairs(self, i: np.ndarray, other: Rows, j: np.ndarray, mirrored: bool) -> np.ndarray:
        a, b = self.ids[i], other.ids[j]
        if mirrored:
            a, b = np.minimum(a, b), np.maximum(a, b)
        else:
            left = self.role[i] == 0
            a, b = np.where(left, a, b), np.where(left, b, a)
        return np.stack([a, b], axis=1)


_COLUMNS = ("role", "ordinal", "at", "size", "b0", "b1", "b2", "b3")


def _compare(jaccard: float, containment: float, window: int | None, mirrored: bool, rows: int = 100_000):
    """Input sorted by (key, salt). Pairs of the tokens of up to BLOCK rows that lie in one task; the rows of a larger or salted token go out as packed blocks."""
    spilled: tuple[int, int] = (0, -1)  # the token whose first rows went out already

    def close(part: pd.DataFrame) -> pd.DataFrame:
        key, whole = part["key"].to_numpy(dtype=np.int64), Rows(part)
        found, step, alive = [np.empty((0, 2), dtype=np.int64)], 1, np.arange(len(part))
        while True:
            alive = alive[alive + step < len(part)]
            alive = alive[key[alive] == key[alive + step]]
            if not len(alive):
                break
            good = alive[whole.passing(alive, whole, alive + step, jaccard, containment, window, mirrored)]
            found.append(whole.pairs(good, whole, good + step, mirrored))
            step += 1
        pairs = pd.DataFrame(np.concatenate(found), columns=["a", "b"]).drop_duplicates()
        return pd.DataFrame({"a": pairs["a"], "b": pairs["b"], "key": 0, "salt": np.int32(0), "n0": np.int32(0), "rows": None})

    def packed(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for (key, salt), block in part.groupby(["key", "salt"], sort=False):
            for start in range(0, len(block), BLOCK):
                piece = block.iloc[start : start + BLOCK]
                yield pd.DataFrame({"a": [0], "b": [-1], "key": [key], "salt": [np.int32(salt)], "n0": [np.int32(start // BLOCK)], "rows": [piece[list(_COLUMNS)].to_numpy(dtype=np.int64).tobytes()]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nonlocal spilled
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            if sum(map(len, held)) < rows:
                continue
            part = pd.concat(held, ignore_index=True)
            last = (part["key"] == part["key"].iloc[-1]) & (part["salt"] == part["salt"].iloc[-1])
            held = [part[last]]
            yield from done(part[~last])
            if len(held[0]) >= rows:  # a large token does not pile up: what is there goes out as blocks
                yield from packed(held[0])
                held, spilled = [], (part["key"].iloc[-1], part["salt"].iloc[-1])
        if held:
            yield from done(pd.concat(held, ignore_index=True))

    def done(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(part):
            return
        salted = (part["salts"] > 1) | (part.groupby("key")["key"].transform("size") > BLOCK) | ((part["key"] == spilled[0]) & (part["salt"] == spilled[1]))
        if (~salted).any():
            found = close(part[~salted].reset_index(drop=True))
            if len(found):
                yield found
        if salted.any():
            yield from packed(part[salted])

    return run


def _cells(jaccard: float, containment: float, window: int | None, mirrored: bool):
    """Pairs of the rows of two packed blocks of one token."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for x, y in zip(batch["x"], batch["y"], strict=True):
                left, right = (Rows(pd.DataFrame(np.frombuffer(v, dtype=np.int64).reshape(-1, len(_COLUMNS)), columns=list(_COLUMNS))) for v in (x, y))
                for start in range(0, len(left.ids), 64):
                    i = np.repeat(np.arange(start, min(start + 64, len(left.ids))), len(right.ids))
                    j = np.tile(np.arange(len(right.ids)), len(i) // max(1, len(right.ids)))
                    good = left.passing(i, right, j, jaccard, containment, window, mirrored)
                    if good.any():
                        pairs = left.pairs(i[good], right, j[good], mirrored)
                        yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _candidates(postings: DataFrame, jaccard: float, containment: float, window: int | None, mirrored: bool) -> DataFrame:
    sorted_ = postings.repartition("key", "salt").sortWithinPartitions("key", "salt")
    found = cut(sorted_.mapInPandas(_compare(jaccard, containment, window, mirrored), _FOUND), "found")
    blocks = found.where("b = -1").select("key", F.struct("salt", "n0", F.xxhash64("rows").alias("h")).alias("i"), "rows")
    left = blocks.select("key", F.col("i").alias("_i"), F.col("rows").alias("x"))
    right = blocks.select(F.col("key").alias("_key"), F.col("i").alias("_j"), F.col("rows").alias("y"))
    cells = left.join(right, (F.col("key") == F.col("_key")) & (F.col("_i") <= F.col("_j"))).select("x", "y")
    far = cells.repartition(F.xxhash64("x", "y")).mapInPandas(_cells(jaccard, containment, window, mirrored), "a long, b long")
    return found.where("b <> -1").select("a", "b").unionByName(far).distinct()


def self_candidates(rows: DataFrame, jaccard: float, containment: float, window: int) -> DataFrame:
    """(a, b) with a < b of rows(ordinal, at, tokens) within the window that are alike enough; rows without tokens are in no pair."""
    none = F.array().cast("array<string>")
    return windowjoin.self_pairs(rows.select("ordinal", "at", "tokens", F.lit("").alias("source"), F.lit(False).alias("release"), none.alias("ids")), jaccard, containment, window).select("a", "b")


def cross_candidates(left: DataFrame, right: DataFrame, jaccard: float, containment: float) -> DataFrame:
    """(a, b), a of the left and b of the right rows(ordinal, at, tokens, group); only rows of equal groups meet."""
    a, b = _hashed(left, True), _hashed(right, True)
    shared = left.sparkSession.sparkContext.broadcast(frequencies(a.unionByName(b)))  # SLOTS numbers
    sides = [side.mapInPandas(_postings(shared, jaccard, None, role), _POSTING) for role, side in enumerate((a, b))]
    return _candidates(sides[0].unionByName(sides[1]), jaccard, containment, None, False)
