"""Exact set-similarity self-join within a time window: rows meet in time slots, pairs are decided where they meet, and only pairs are written.

A slot is as long as the window, so a row meets all its partners in its own slot (home) and in the next (guest); of each pair one row is at home
in exactly one place, so nothing has to be made distinct. Rows travel with the hashes of their tokens (64 bits), twice each. A slot of more than HELD
rows is divided into an odd number of parts: a row is at home in one, a guest in half of the others and in all parts of the next slot. A task holds the
homes of one part; guests stream past in chunks.

In a part, tokens are ranked by their frequency among the homes. Where rare tokens prune, candidates come from an index of prefixes: two sets of Jaccard at
least t share one of the first n - ceil(t n) + 1 elements of each in any common order. Where they would give more hits than there are pairs, all pairs in
time are bounded by a matrix product: tokens are spread over COLUMNS columns, and the product of the counts of two rows is at least what they share. Both ways are
lossless; what passes is bounded again by wide bitmaps and counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HELD = 1 << 17
COLUMNS, BITS = 256, 1024
ROWS, OTHERS = 1_024, 4_096
AT_ONCE = 8 * ROWS
HITS = 1 << 22
INDEXED = 6  # a hit of the index costs about as much as six pairs of the product
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("common", pa.int32()), ("size_a", pa.int32()), ("size_b", pa.int32())])
_SENT = ("slot", "part", "role", "at", "ordinal", "source", "release", "ids", "hashes")


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[k], starts[k] + 1, ... of lengths[k] each, one after the other."""
    return np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


class _Ranks:
    """The tokens of the homes, the most frequent first."""

    def __init__(self, tokens: np.ndarray) -> None:
        self.tokens, counts = np.unique(tokens, return_counts=True)
        self.of = np.empty(len(counts), dtype=np.int64)
        self.of[np.lexsort((self.tokens, -counts))] = np.arange(len(counts))

    def look(self, tokens: np.ndarray) -> np.ndarray:
        """Ranks; -1 for a token that no home has."""
        if not len(self.tokens):
            return np.full(len(tokens), -1)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.of[at], -1)


class _Rows:
    """Rows of one part, in the order of time."""

    def __init__(self, table: pa.Table, ranks: tuple[_Ranks, _Ranks] | None = None) -> None:
        table = table.combine_chunks()
        batch = table.to_batches()[0]
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        self.at, self.ordinal, self.source = (column(c).to_numpy(zero_copy_only=False) for c in ("at", "ordinal", "source"))
        self.release = column("release").to_numpy(zero_copy_only=False).astype(bool)
        (tokens, token_ends), (ids, id_ends) = _flat(column("hashes")), _flat(column("ids"))
        self.size = np.diff(token_ends)
        self.ranks = ranks or (_Ranks(tokens), _Ranks(ids))
        self.rank, self.owner, self.ends = self.ranked(tokens, self.size, self.ranks[0])
        self.known = np.diff(self.ends)
        self.id, self.id_owner, self.id_ends = self.ranked(ids, np.diff(id_ends), self.ranks[1])
        self.bits = np.empty((len(self.size), BITS // 64), dtype=np.uint64)
        self.counts = np.empty((len(self.size), COLUMNS), dtype=np.uint8)
        turn, column_of = np.divmod(self.rank, COLUMNS)
        column_of = np.where(turn % 2 == 0, column_of, COLUMNS - 1 - column_of)
        for start in range(0, len(self.size), OTHERS):
            stop = min(start + OTHERS, len(self.size))
            here = slice(self.ends[start], self.ends[stop])
            own = self.owner[here] - start
            flags = np.zeros((stop - start, BITS), dtype=bool)
            flags[own, self.rank[here] % BITS] = True
            self.bits[start:stop] = np.packbits(flags, axis=1).view(np.uint64)
            counts = np.bincount(own * COLUMNS + column_of[here], minlength=(stop - start) * COLUMNS)
            self.counts[start:stop] = np.minimum(counts, 255).reshape(-1, COLUMNS)
        self.full = np.flatnonzero(self.counts.max(axis=1, initial=0) == 255)  # counts beyond that were cut

    @staticmethod
    def ranked(values: np.ndarray, sizes: np.ndarray, ranks: _Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranks of the known values of each row, rare ones first, their rows, and where each row's end."""
        rank, owner = ranks.look(values), np.repeat(np.arange(len(sizes)), sizes)
        owner, rank = owner[rank >= 0], rank[rank >= 0]
        order = np.lexsort((-rank, owner))
        return rank[order].astype(np.int32), owner[order].astype(np.int32), np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(sizes)))))

    def __len__(self) -> int:
        return len(self.size)

    def prefixes(self, start: int, stop: int, jaccard: float) -> tuple[np.ndarray, np.ndarray]:
        """(rank, row) of the tokens of each row's prefix that some home has; those that none has come first in the order and count."""
        here = slice(self.ends[start], self.ends[stop])
        owner = self.owner[here]
        place = np.arange(here.start, here.stop) - self.ends[owner] + (self.size - self.known)[owner]
        kept = place < (self.size - np.ceil(jaccard * self.size - 1e-9) + 1)[owner]
        return self.rank[here][kept], owner[kept]

    def factor(self, start: int, stop: int, share: float, left: bool) -> np.ndarray:
        """Counts and two more columns, so that the product of a left and a right row is what they may share less what they need to."""
        out = np.empty((stop - start, COLUMNS + 2), dtype=np.float32)
        out[:, :COLUMNS] = self.counts[start:stop]
        out[:, COLUMNS + (not left)], out[:, COLUMNS + left] = -share * self.size[start:stop], 1
        return out


class _Part:
    """The homes of one part, met by each other and by guests."""

    def __init__(self, homes: pa.Table, jaccard: float, containment: float, window: int) -> None:
        self.homes, self.jaccard, self.containment, self.window = _Rows(homes), jaccard, containment, window
        rank, row = self.homes.prefixes(0, len(self.homes), jaccard)
        order = np.argsort(rank, kind="stable")
        self.posted, self.posted_rows = rank[order], row[order]
        order = np.argsort(self.homes.id, kind="stable")
        self.named, self.named_rows = self.homes.id[order], self.homes.id_owner[order]

    def met(self, rows: _Rows, guests: bool) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(rows), AT_ONCE):
            stop = min(start + AT_ONCE, len(rows))
            low, high = np.searchsorted(self.homes.at, rows.at[start:stop] - self.window), np.searchsorted(self.homes.at, rows.at[start:stop] + self.window, side="right")
            rank, owner = rows.prefixes(start, stop, self.jaccard)
            first = np.searchsorted(self.posted, rank)
            hits = np.searchsorted(self.posted, rank, side="right") - first
            few = hits.sum() * INDEXED < (high - low).sum()
            for i, j in self.sharing(self.posted_rows, owner, first, hits) if few else self.bounded(rows, start, stop, low, high, guests):
                yield from self.decided(rows, i, j, guests, False)
            here = slice(rows.id_ends[start], rows.id_ends[stop])
            first = np.searchsorted(self.named, rows.id[here])
            hits = np.searchsorted(self.named, rows.id[here], side="right") - first
            for i, j in self.sharing(self.named_rows, rows.id_owner[here], first, hits):
                yield from self.decided(rows, i, j, guests, True)

    def sharing(self, posted: np.ndarray, owner: np.ndarray, first: np.ndarray, hits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (row, home), each once: the homes posted[first : first + hits] of the entries of each row; owner is ascending."""
        total = np.cumsum(hits)
        start = 0
        while start < len(owner):
            until = int(np.searchsorted(total, (total[start - 1] if start else 0) + HITS, side="right"))
            stop = int(np.searchsorted(owner, owner[until])) if until < len(owner) else until  # whole rows
            stop = stop if stop > start else int(np.searchsorted(owner, owner[start], side="right"))
            here = slice(start, stop)
            pairs = np.unique(np.repeat(owner[here].astype(np.int64), hits[here]) * len(self.homes) + posted[_ragged(first[here], hits[here])])
            yield np.divmod(pairs, len(self.homes))
            start = stop

    def bounded(self, rows: _Rows, start: int, stop: int, low: np.ndarray, high: np.ndarray, guests: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (row, home) in time whose product of counts reaches what they need to share; low, high: the homes in time of the rows start to stop."""
        share = self.jaccard / (1 + self.jaccard)
        for at in range(start, stop, ROWS):
            end = min(at + ROWS, stop)
            left = rows.factor(at, end, share, True)
            last = int(high[at - start : end - start].max()) if guests else end
            for begin in range(int(low[at - start : end - start].min()), last, OTHERS):
                until = min(begin + OTHERS, last)
                passing = left @ self.homes.factor(begin, until, share, False).T >= -0.01
                passing[rows.full[(rows.full >= at) & (rows.full < end)] - at] = True
                passing[:, self.homes.full[(self.homes.full >= begin) & (self.homes.full < until)] - begin] = True
                i, j = np.divmod(np.flatnonzero(passing), until - begin)
                yield i + at, j + begin

    def decided(self, rows: _Rows, i: np.ndarray, j: np.ndarray, guests: bool, named: bool) -> Iterator[pa.RecordBatch]:
        """The pairs among those given; of pairs that share no identifier those alike enough, of the others (named) all."""
        for start in range(0, len(i), 1 << 16):
            yield from self._decided(rows, i[start : start + (1 << 16)], j[start : start + (1 << 16)], guests, named)

    def _decided(self, rows: _Rows, i: np.ndarray, j: np.ndarray, guests: bool, named: bool) -> Iterator[pa.RecordBatch]:
        homes = self.homes
        kept = (np.abs(rows.at[i] - homes.at[j]) <= self.window) & (rows.ordinal[i] != homes.ordinal[j])
        if not guests:
            kept &= j < i
        i, j = i[kept], j[kept]
        if not named:
            most = (rows.known[i] + homes.known[j] - np.bitwise_count(rows.bits[i] ^ homes.bits[j]).sum(axis=1, dtype=np.int64)) // 2
            kept = self.enough(most, rows.size[i], homes.size[j])
            i, j = i[kept], j[kept]
        if not len(i):
            return
        common = self.shared(rows.rank, rows.ends, i, self.homes.rank, self.homes.ends, j)
        swapped = rows.ordinal[i] > homes.ordinal[j]
        if not named:
            release = np.where(swapped, homes.release[j], rows.release[i])
            one_source = (rows.source[i] == homes.source[j]) | (rows.source[i] == 0) | (homes.source[j] == 0)
            kept = self.enough(common, rows.size[i], homes.size[j]) & ~(release & one_source) & (self.shared(rows.id, rows.id_ends, i, homes.id, homes.id_ends, j) == 0)
            i, j, common, swapped = i[kept], j[kept], common[kept], swapped[kept]
        x, y, nx, ny = rows.ordinal[i], homes.ordinal[j], rows.size[i], homes.size[j]
        columns = (np.where(swapped, y, x), np.where(swapped, x, y), common, np.where(swapped, ny, nx), np.where(swapped, nx, ny))
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(t.type.to_pandas_dtype())) for c, t in zip(columns, _PAIRS, strict=True)], schema=_PAIRS)

    def enough(self, common: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
        least = np.minimum(m, n)
        return (least > 0) & (common >= self.jaccard * (m + n - common) - 1e-9) & (common >= self.containment * least - 1e-9)

    @staticmethod
    def shared(left: np.ndarray, left_ends: np.ndarray, i: np.ndarray, right: np.ndarray, right_ends: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values each pair shares, from the values of both sides and where each row's end."""
        size, at = int(right.max(initial=-1)) + 1, np.arange(len(i))
        keys = []
        for values, ends, k in ((left, left_ends, i), (right, right_ends, j)):
            n = ends[k + 1] - ends[k]
            keys.append(np.repeat(at, n) * size + values[_ragged(ends[k], n)])
        both = np.sort(np.concatenate(keys))
        return np.bincount(both[1:][both[1:] == both[:-1]] // max(1, size), minlength=len(i))

def _join(jaccard: float, containment: float, window: int):
    """Input sorted by slot, part, role and time: the homes of a part, then its guests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        held: list[pa.RecordBatch] = []
        part: _Part | None = None

        def done() -> Iterator[pa.RecordBatch]:
            """What is held makes the homes of the part, or has met them."""
            nonlocal part
            if not held:
                return
            rows = pa.Table.from_batches(held)
            held.clear()
            if key[2] == 0:
                part = _Part(rows, jaccard, containment, window)
                yield from part.met(part.homes, False)
            elif part is not None:
                yield from part.met(_Rows(rows, part.homes.ranks), True)

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)], axis=1)
            starts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]))
            for start, stop in zip(starts[:-1], starts[1:], strict=True):
                if start == stop:
                    continue
                now = tuple(keys[start].tolist())
                if now != key:
                    yield from done()
                    if key is None or now[:2] != key[:2]:
                        part = None
                    key = now
                if now[2] == 0 or part is not None:
                    held.append(batch.slice(start, stop - start))
                if now[2] == 1 and sum(b.num_rows for b in held) >= OTHERS:
                    yield from done()
        yield from done()

    return run


def _targets(rows: DataFrame, window: int, held: int) -> Column:
    """(slot, part, role) of all places a row is sent to. Only the slots of more than `held` rows come to the driver."""
    slot = F.expr(f"(at - pmod(at, {window}L)) div {window}L")
    large = {r.slot: -(-r.n // held) // 2 * 2 + 1 for r in rows.groupBy(slot.alias("slot")).agg(F.count("*").alias("n")).where(F.col("n") > held).collect()}
    place = lambda s, p, r: F.struct(s.alias("slot"), p.cast("int").alias("part"), F.lit(r).alias("role"))
    if not large:
        return F.array(place(slot, F.lit(0), 0), place(slot + 1, F.lit(0), 1))
    known = F.create_map(*[F.lit(x).cast("long") for pair in large.items() for x in pair])
    parts = lambda s: F.coalesce(F.try_element_at(known, s), F.lit(1).cast("long"))
    own = F.pmod(F.xxhash64("ordinal"), parts(slot))
    beside = F.transform(F.filter(F.sequence(F.lit(0).cast("long"), F.shiftright(parts(slot), 1)), lambda k: k > 0), lambda k: place(slot, F.pmod(own + k, parts(slot)), 1))
    return F.concat(F.array(place(slot, own, 0)), beside, F.transform(F.sequence(F.lit(0).cast("long"), parts(slot + 1) - 1), lambda p: place(slot + 1, p, 1)))


def self_pairs(rows: DataFrame, jaccard: float, containment: float, window: int, held: int | None = None) -> DataFrame:
    """(a, b, common, size_a, size_b) with a < b of rows(ordinal, at, tokens, source, release, ids) within the window: pairs that share an identifier, or
    are alike enough unless they have one source (or an unknown one) and the first is a release. Rows without time or ordinal are in no pair."""
    present = rows.where("ordinal is not null and at is not null")
    hashed = lambda c: F.transform(c, lambda t: F.xxhash64(t))
    source = F.when(F.col("source").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("source"))
    small = present.select("ordinal", "at", source.alias("source"), F.coalesce("release", F.lit(True)).alias("release"), hashed("ids").alias("ids"), hashed("tokens").alias("hashes"))
    sent = small.withColumn("_to", F.explode(_targets(present.select("at"), window, held or HELD))).select("_to.*", *_SENT[3:])
    ordered = sent.repartition("slot", "part").sortWithinPartitions("slot", "part", "role", "at")
    return ordered.mapInArrow(_join(jaccard, containment, window), "a long, b long, common int, size_a int, size_b int")
