"""Groups of near copies: records whose word runs are at least half shared, across collections too large for pairwise comparison.

Title and main body become runs of three words (of three characters in Chinese), case and punctuation ignored. Min-hashes of the
runs give banded keys, which propose pairs, and a sketch of one bit per hash. Proposed pairs pass the bit-sliced comparison of
their sketches (bitslice.py) and then an exact Jaccard check on the runs; accepted links are contracted to components.
Records with one and the same text are one node throughout: a task bands a text once (as long as it remembers it), copies from several tasks meet in their bucket
and are dropped there, so a text repeated in a third of all rows costs a few rows for each task.

With 42 bands of 3 hashes (all the sketch has) a link at exactly one half is proposed with probability 0.996, at 0.6 with 0.99995; what no band
proposes is not found. The sketch radius is four standard deviations beyond the expected distance at one half. The band rows carry the sketch and travel packed
by slot, a slot for every million of them; a task sorts its slot, turns the
sketches of the buckets into vertical planes once and compares each bucket where it lies. Buckets larger than a block go out as packed blocks of
planes, and each pair of blocks is one row of work for some task. Records without any word match nothing; null titles and summaries count as empty; rows repeated under
other ordinals are members of one group.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestflow.llm import bitslice
from digestflow.llm.base import skip_empty
from digestflow.operators.components import connected_components
from digestflow.session import cut

BANDS, ROWS, SKETCH_BITS = 42, 3, 128
THRESHOLD, RADIUS = 0.5, 52
BLOCK, CELL = 256, 1_024
SLOT, PIECE, HELD = 1_000_000, 200_000, 4_000_000
REMEMBERED = 200_000
MAX_FILTER_BITS = 1 << 25
_WORD = re.compile(r"[^\W_]+")
_ASCII_BREAKS = bytes(c if chr(c).isalnum() else 32 for c in range(128)).lower() + bytes(128)
_HAN = re.compile(r"[㐀-䶿一-鿿]")
DIGESTS = "ordinal long, text_key long, runs binary"
_rng = np.random.default_rng(20240229)
_A = (_rng.integers(0, 1 << 63, SKETCH_BITS, dtype=np.uint64) << np.uint64(1) | np.uint64(1))[:, None]
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of words, remembered up to a limit."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < 50_000:
            self[word] = h
        return h


def _words(text: str) -> tuple[str, list[str] | None]:
    """The text in lower case without punctuation, and its words; no list for a text of Chinese characters."""
    if text.isascii():
        found = text.encode("ascii").translate(_ASCII_BREAKS).decode("ascii").split()
        return " ".join(found), found
    text = text.lower()
    found = _WORD.findall(text)
    if len(_HAN.findall(text)) * 4 > len(text):
        return "".join(found), None
    return " ".join(found), found


def all_runs(texts: Iterable[str], words: WordHashes, width: int = 3, held: int = 100_000) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Keys of the normalised texts and the sorted distinct hashes (32 bits) of the runs of each, some `held` words at a time; key 0 for a text without words."""
    keys: list[int] = []
    parts: list[np.ndarray] = []
    lengths: list[int] = []
    pending: list[str] = []
    size = 0

    def flush() -> None:
        if pending:
            parts.append(np.fromiter(map(words.__getitem__, pending), dtype=np.uint64, count=len(pending)))
            pending.clear()

    def finish() -> tuple[list[int], list[np.ndarray]]:
        flush()
        return keys, _distinct_runs(np.concatenate([*parts, np.empty(0, dtype=np.uint64)]), np.array(lengths), width)

    for text in texts:
        joined, found = _words(text)
        if found is None:
            flush()
            parts.append(np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64))
            lengths.append(len(joined))
        else:
            pending.extend(found)
            lengths.append(len(found))
        keys.append(xxhash.xxh64_intdigest(joined) >> 1 if joined else 0)
        size += lengths[-1]
        if size >= held:
            yield finish()
            keys, parts, lengths, size = [], [], [], 0
    if keys:
        yield finish()


def _distinct_runs(units: np.ndarray, lengths: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of each text, whose units follow one another; a text of fewer units than a run is one run."""
    ends = np.cumsum(lengths)
    counts = np.where(lengths > 0, np.maximum(lengths - width + 1, 1), 0)
    text = np.repeat(np.arange(len(lengths), dtype=np.uint64), counts)
    at = np.arange(len(text)) + np.repeat(ends - lengths - (np.cumsum(counts) - counts), counts)
    short = np.repeat(lengths, counts) if (lengths < width).any() else None
    mixed = units[at]
    for i in range(1, width):
        if short is None:
            mixed = mixed * _M1 + (units[at + i] ^ _M2)
        else:
            more = short > i
            mixed[more] = mixed[more] * _M1 + (units[at[more] + i] ^ _M2)
    both = np.sort(text << np.uint64(32) | _mix(mixed) >> np.uint64(32))
    both = both[np.concatenate((np.ones(min(1, len(both)), dtype=bool), both[1:] != both[:-1]))]
    return np.split(both.astype(np.uint32), np.searchsorted(both, np.arange(1, len(lengths), dtype=np.uint64) << np.uint64(32))) if len(lengths) else []


def runs(text: str, words: WordHashes, width: int = 3) -> tuple[int, np.ndarray]:
    """Key and runs of one text."""
    keys, found = next(all_runs([text], words, width))
    return keys[0], found[0]


def min_hashes(run_hashes: np.ndarray, mixed_again: bool = True) -> np.ndarray:
    """SKETCH_BITS min-hashes of a set of run hashes."""
    least = np.full(SKETCH_BITS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(run_hashes), 8192):
        mixed = _mix(run_hashes[start : start + 8192].astype(np.uint64) + _M2)
        least = np.minimum(least, (mixed[None, :] * _A).min(axis=1))
    return _mix(least) if mixed_again else least


def all_min_hashes(run_hashes: list[np.ndarray], rows: int = 8192, columns: int = 16) -> np.ndarray:
    """The min-hashes of each of several sets, none of them empty, about `rows` run hashes and `columns` of the min-hashes at a time."""
    least = np.empty((len(run_hashes), SKETCH_BITS), dtype=np.uint64)
    ends = np.concatenate(([0], np.cumsum([len(r) for r in run_hashes])))
    start = 0
    while start < len(run_hashes):
        stop = int(np.searchsorted(ends, ends[start] + rows, side="right")) - 1
        if stop <= start:  # a long text alone
            stop = start + 1
            least[start] = min_hashes(run_hashes[start], False)
        else:
            mixed = _mix(np.concatenate(run_hashes[start:stop]).astype(np.uint64) + _M2)
            for i in range(0, SKETCH_BITS, columns):
                least[start:stop, i : i + columns] = np.minimum.reduceat(mixed[None, :] * _A[i : i + columns], ends[start:stop] - ends[start], axis=1).T
        start = stop
    return _mix(least)


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words = WordHashes()
    for batch in batches:
        keys, found = [], []
        for some, those in all_runs((f"{t or ''} {b or ''}" for t, b in zip(batch["title"], batch["body"], strict=True)), words):
            keys += some
            found += [r.tobytes() for r in those]
        yield pd.DataFrame({"ordinal": batch["ordinal"], "text_key": keys, "runs": found})


@skip_empty
def _bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(band, text_key, s0, s1): the banded keys of each text with its sketch of 128 bits."""
    band_number = np.arange(BANDS, dtype=np.uint64)
    told: set[int] = set()
    for batch in batches:
        batch = batch.drop_duplicates("text_key")
        batch = batch[[k not in told for k in batch["text_key"]]]
        if not len(batch):
            continue
        if len(told) > REMEMBERED:
            told.clear()
        told.update(batch["text_key"])
        mins = all_min_hashes([np.frombuffer(r, dtype=np.uint32) for r in batch["runs"]])
        grouped = mins[:, : BANDS * ROWS].reshape(len(mins), BANDS, ROWS)
        band = grouped[:, :, 0].copy()
        for i in range(1, ROWS):
            band = band * _M1 + grouped[:, :, i]
        band = (_mix(band + band_number[None, :]) >> np.uint64(8)).astype(np.int64)
        sketch = np.packbits((mins & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64)
        yield pd.DataFrame({"band": band.ravel(), "text_key": np.repeat(batch["text_key"].to_numpy(), BANDS), "s0": np.repeat(sketch[:, 0], BANDS), "s1": np.repeat(sketch[:, 1], BANDS)})


def _slotted(slots: int, held: int = 500_000):
    """Function for mapInPandas: the rows of _bands (four numbers each) packed by slot, a slot's rows of about `held` / BANDS texts in one value."""

    def pack(frames: list[pd.DataFrame]) -> pd.DataFrame:
        rows = np.concatenate([f.to_numpy() for f in frames])
        slot = rows[:, 0] % slots
        order = np.argsort(slot.astype(np.int32), kind="stable")
        rows, ends = rows[order], np.cumsum(np.bincount(slot, minlength=slots))
        used = np.flatnonzero(np.diff(ends, prepend=0))
        return pd.DataFrame({"slot": used.astype(np.int32), "rows": [p.tobytes() for p in np.split(rows, ends[used[:-1]])]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames: list[pd.DataFrame] = []
        for frame in _bands(batches):
            frames.append(frame)
            if sum(map(len, frames)) >= held:
                yield pack(frames)
                frames = []
        if frames:
            yield pack(frames)

    return run


def _bucket_pairs(part: np.ndarray) -> np.ndarray:
    """Pairs (a < b) of different texts of one bucket within the radius; part: (band, text_key, s0, s1) sorted by band and text, each text once in a bucket."""
    vertical = bitslice.planes(np.ascontiguousarray(part[:, 2:]).view(np.uint8))
    found = [np.empty((0, 2), dtype=np.int64)]
    for step in range(1, len(part)):
        same = np.zeros(len(part), dtype=bool)
        same[:-step] = part[:-step, 0] == part[step:, 0]
        if not same.any():
            break
        near = np.flatnonzero(bitslice.near_at(vertical, step, same, RADIUS))
        found.append(np.stack([part[near, 1], part[near + step, 1]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


_NEAR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("band", pa.int64()), ("keys", pa.binary()), ("planes", pa.binary())])


def _pack(part: np.ndarray) -> pa.RecordBatch:
    """The rows of one large bucket as blocks of up to CELL texts: their keys and their planes."""
    blocks = [part[i : i + CELL] for i in range(0, len(part), CELL)]
    n, zeros = len(blocks), np.zeros(len(blocks), dtype=np.int64)
    keys, vertical = [np.ascontiguousarray(p[:, 1]).tobytes() for p in blocks], [bitslice.planes(np.ascontiguousarray(p[:, 2:]).view(np.uint8)).tobytes() for p in blocks]
    return pa.RecordBatch.from_arrays([pa.array(zeros), pa.array(zeros), pa.array(np.full(n, part[0, 0])), pa.array(keys, pa.binary()), pa.array(vertical, pa.binary())], schema=_NEAR)


def _sorted(rows: np.ndarray) -> np.ndarray:
    """Rows sorted by band and text, each text once in a bucket: copies come from several tasks."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    return rows[np.concatenate(([True], (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])))]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows of one slot or several. Pairs (a, b) of the buckets up to BLOCK texts; larger buckets go out as packed blocks (band, keys, planes)."""
    held: list[np.ndarray] = []
    large = np.empty(0, dtype=np.int64)
    size, limit = 0, HELD

    def packed(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = _sorted(rows)
        for part in np.split(rows, np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1):
            yield _pack(part)

    def finish(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(rows[:, 0])
        band = rows[order, 0]
        beside = np.concatenate(([False], band[1:] == band[:-1]))
        rows = rows[order[beside | np.append(beside[1:], False)]]  # a text alone in its bucket meets none
        found = [np.empty((0, 2), dtype=np.int64)]
        start = 0
        while start < len(rows):
            stop = start + PIECE
            if stop < len(rows):  # to the end of the bucket
                stop = int(np.searchsorted(rows[:, 0], rows[stop, 0], side="right"))
            piece = _sorted(rows[start:stop])
            starts = np.flatnonzero(np.concatenate(([True], piece[1:, 0] != piece[:-1, 0])))
            sizes = np.diff(np.append(starts, len(piece)))
            found.append(_bucket_pairs(piece[np.repeat(sizes <= BLOCK, sizes)]))
            for i, n in zip(starts[sizes > BLOCK], sizes[sizes > BLOCK], strict=True):
                yield _pack(piece[i : i + n])
            start = stop
        pairs = np.unique(np.concatenate(found), axis=0)
        none = pa.nulls(len(pairs), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(np.zeros(len(pairs), dtype=np.int64)), none, none], schema=_NEAR)

    for batch in batches:
        for value in batch.column("rows"):
            held.append(np.frombuffer(value.as_buffer(), dtype=np.int64).reshape(-1, 4))
            size += len(held[-1])
            if size > limit:  # a very large bucket does not pile up
                rows = np.concatenate(held)
                band, n = np.unique(rows[:, 0], return_counts=True)
                large = np.union1d(large, band[n > 64 * CELL])
                go = np.isin(rows[:, 0], large)
                if go.any():
                    yield from packed(rows[go])
                held = [rows[~go]]
                size = len(held[0])
                limit = max(HELD, 2 * size)
    if size:
        rows = np.concatenate(held)
        held.clear()
        if len(large) and (go := np.isin(rows[:, 0], large)).any():
            yield from packed(rows[go])
            rows = rows[~go]
        yield from finish(rows)


@skip_empty
def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keep = []
        for ra, rb in zip(batch["runs_a"], batch["runs_b"], strict=True):
            x, y = np.frombuffer(ra, dtype=np.uint32), np.frombuffer(rb, dtype=np.uint32)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(common >= THRESHOLD * (len(x) + len(y) - common))
        yield batch.loc[np.array(keep, dtype=bool), ["a", "b"]]


@skip_empty
def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs (a < b) of different texts of two packed blocks of one bucket."""
    for batch in batches:
        for kx, px, ky, py in zip(batch["keys_x"], batch["planes_x"], batch["keys_y"], batch["planes_y"], strict=True):
            x, y = np.frombuffer(kx, dtype=np.int64), np.frombuffer(ky, dtype=np.int64)
            near = bitslice.near_across(np.frombuffer(px, dtype=np.uint64).reshape(SKETCH_BITS, -1), len(x), np.frombuffer(py, dtype=np.uint64).reshape(SKETCH_BITS, -1), len(y), RADIUS)
            j, i = np.nonzero(near)
            a, b = np.minimum(x[i], y[j]), np.maximum(x[i], y[j])
            found = np.unique(np.stack([a, b], axis=1)[a != b], axis=0)
            yield pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})


def digests(bodies: DataFrame) -> DataFrame:
    """bodies(ordinal, title, body) to a written table (ordinal, text_key, runs)."""
    return cut(bodies.select("ordinal", "title", "body").mapInPandas(_digest, DIGESTS), "runs")


def _filter_bits(keys: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter (one hash) over a key column: words of 32 bits, or-ed in one aggregation; at most bits / 32 rows come to the driver."""
    placed = keys.select(F.pmod(F.col("text_key"), F.lit(bits)).alias("p"))
    words = placed.select(F.expr("cast(p div 32 as int)").alias("w"), F.expr("shiftleft(1L, cast(p % 32 as int))").alias("m")).groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()
    out = np.zeros(bits // 32, dtype=np.uint32)
    out[words["w"].to_numpy(dtype=np.int64)] = words["m"].to_numpy(dtype=np.int64).astype(np.uint32)
    return out.view(np.uint8)


def _passing(shared: object, bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = batch["text_key"].to_numpy(dtype=np.int64) % bits
            yield batch[(shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)]

    return run


def _wanted(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each text that stands in a pair, once. A filter of eight bits for each key drops most others in the scan, as long as it stays within MAX_FILTER_BITS; the joins decide in any case."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("text_key"))
    bits = 1 << max(16, (16 * pairs.count()).bit_length())
    if bits <= MAX_FILTER_BITS:
        shared = texts.sparkSession.sparkContext.broadcast(_filter_bits(needed, bits))
        texts = texts.mapInPandas(_passing(shared, bits), texts.schema)
    else:
        texts = texts.join(needed.distinct(), "text_key", "left_semi")
    return texts.dropDuplicates(["text_key"])


def candidates(texts: DataFrame) -> DataFrame:
    """(a, b): pairs of different texts(text_key, runs) that share a band and whose sketches lie within the radius."""
    rows = texts.count() * BANDS
    slots = 1 + max(rows // SLOT, min(8 * rows // SLOT, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1))
    banded = texts.mapInPandas(_slotted(slots), "slot int, rows binary").repartitionById(slots, "slot")
    near = cut(banded.mapInArrow(_buckets, "a long, b long, band long, keys binary, planes binary"), "near")
    blocks = near.where("keys is not null").select("band", F.xxhash64("keys").alias("i"), "keys", "planes")
    left, right = (blocks.select("band", F.col("i").alias(f"i_{s}"), F.col("keys").alias(f"keys_{s}"), F.col("planes").alias(f"planes_{s}")) for s in "xy")
    cells = left.join(right, "band").where("i_x <= i_y").select("keys_x", "planes_x", "keys_y", "planes_y", F.xxhash64("band", "i_x", "i_y").alias("cell")).repartition("cell")
    far = cells.drop("cell").mapInPandas(_cells, "a long, b long")
    pairs = cut(near.where("keys is null").select("a", "b").unionByName(far).distinct(), "pairs")
    return pairs


def links(digested: DataFrame) -> DataFrame:
    """(a, b): pairs of different texts, by text_key, that share at least half of their runs."""
    texts = digested.where("text_key <> 0").select("text_key", "runs")
    pairs = candidates(texts)
    wanted = _wanted(texts, pairs)
    first = pairs.join(wanted.select(F.col("text_key").alias("a"), F.col("runs").alias("runs_a")), "a")
    both = first.join(wanted.select(F.col("text_key").alias("b"), F.col("runs").alias("runs_b")), "b")
    return both.select("a", "b", "runs_a", "runs_b").mapInPandas(_verify, "a long, b long")


@skip_empty
def _prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(run, text_key): the runs one of which any text of Jaccard at least one half must share, in the order of their hashes."""
    for batch in batches:
        kept = [(r[: len(r) - int(np.ceil(THRESHOLD * len(r))) + 1], k) for v, k in zip(batch["runs"], batch["text_key"], strict=True) for r in [np.frombuffer(v, dtype=np.uint32)]]
        yield pd.DataFrame({"run": np.concatenate([r for r, _ in kept]).astype(np.int64), "text_key": np.repeat([k for _, k in kept], [len(r) for r, _ in kept])})


def link_recall(digested: DataFrame, found: DataFrame, every: int = 20) -> DataFrame:
    """One row (queries, expected, hits, recall): of all links of the texts of rows with an ordinal divisible by `every`, those that the bands found. The expected ones come from a complete join by prefix filter."""
    texts = cut(digested.where("text_key <> 0").select("text_key", "runs", (F.col("ordinal") % every == 0).alias("asked")).groupBy("text_key").agg(F.max("asked").alias("asked"), F.first("runs").alias("runs")), "texts")
    asked = texts.where("asked").select("text_key", "runs")
    sides = texts.select("text_key", "runs").mapInPandas(_prefixes, "run long, text_key long").join(asked.mapInPandas(_prefixes, "run long, text_key long").withColumnRenamed("text_key", "q"), "run")
    pairs = sides.where("q <> text_key").select(F.col("q").alias("a"), F.col("text_key").alias("b")).distinct()
    both = pairs.join(texts.select(F.col("text_key").alias("a"), F.col("runs").alias("runs_a")), "a").join(texts.select(F.col("text_key").alias("b"), F.col("runs").alias("runs_b")), "b")
    due = both.mapInPandas(_verify, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    hits = due.join(found.withColumn("hit", F.lit(1)), ["a", "b"], "left").agg(F.count("*").alias("expected"), F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"))
    return asked.agg(F.count("*").alias("queries")).crossJoin(hits).withColumn("recall", F.when(F.col("expected") > 0, F.round(F.col("hits") / F.col("expected"), 6)).otherwise(1.0))  # one row each


def groups(bodies: DataFrame) -> DataFrame:
    """(ordinal, group_id) of every record with words; group_id is the least text key of the component."""
    return grouped(digests(bodies))


def grouped(digested: DataFrame) -> DataFrame:
    """groups() of a written table (ordinal, text_key, runs)."""
    components = connected_components(links(digested)).select(F.col("node").alias("text_key"), "component")
    return digested.where("text_key <> 0").select("ordinal", "text_key").join(components, "text_key", "left").select("ordinal", F.coalesce("component", "text_key").alias("group_id"))


def group_pairs(membership: DataFrame, block: int = 2000) -> DataFrame:
    """(ordinal_a, ordinal_b): all pairs within a group, smaller ordinal first; a large group is spread over several tasks."""
    membership = cut(membership, "groups")
    sizes = membership.groupBy("group_id").agg(F.count("*").alias("size")).where("size > 1")
    members = membership.join(sizes, "group_id")
    slots = F.ceil(F.col("size") / F.lit(block)).cast("int")
    left = members.select("group_id", F.col("ordinal").alias("ordinal_a"), F.pmod("ordinal", slots).cast("int").alias("slot"))
    right = members.select("group_id", F.col("ordinal").alias("ordinal_b"), F.explode(F.sequence(F.lit(0), slots - 1)).alias("slot"))
    return left.join(right, ["group_id", "slot"]).where("ordinal_a < ordinal_b").select("ordinal_a", "ordinal_b")
