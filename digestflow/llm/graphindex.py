"""Index of titles in navigable small-world graphs, one set of shards for each segment of the history.

Titles are sketched in 128 bits (sign sums of hashed words and word pairs). A shard holds up to SHARD_ROWS sketches and a graph in which every node is
linked to its nearest earlier nodes and back. Search walks many queries at once: the best open candidates of each beam are expanded together. Each shard
keeps the narrowest beam that reaches TARGET recall against exhaustive search on a sample of its own nodes. Found neighbours are ranked
again by the exact share of common words. A new batch becomes a new shard and leaves the others alone; `compaction` says which batches are merged.

Rows without ordinal or title are not indexed; equal titles are nodes of their own and at distance zero; an empty index answers nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from digestflow.llm.base import skip_empty
from digestflow.session import cut

SHARD_ROWS = 10_000
DEGREE = 16
BEAMS, TARGET, SAMPLE = (16, 32, 64, 128, 256), 0.98, 128
QUERY_BLOCK = 2_048
RADIUS = 32
_WORD = re.compile(r"[^\W_㐀-鿿]+|[㐀-鿿]")


def sketch(title: str, memo: dict[str, np.ndarray]) -> np.ndarray:
    """128 bits: signs of the sums of hashed words and pairs of neighbours."""
    words = _WORD.findall(title.lower())
    total = np.zeros(128, dtype=np.int32)
    for feature in [*words, *map(" ".join, zip(words, words[1:], strict=False))]:
        v = memo.get(feature)
        if v is None:
            bits = np.frombuffer(xxhash.xxh3_128_digest(feature), dtype=np.uint8)
            v = memo[feature] = np.unpackbits(bits).astype(np.int8) * 2 - 1
            if len(memo) > 200_000:
                memo.clear()
        total += v
    return np.packbits(total > 0).view(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


def walk(points: np.ndarray, graph: np.ndarray, queries: np.ndarray, beam: int, filled: int, expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances (queries x beam, ascending) of the nearest of the first `filled` points found from a spread of entry points; -1 where none."""
    q = len(queries)
    entries = np.unique(np.linspace(0, filled - 1, min(filled, max(64, 2 * beam))).astype(np.int32))
    ids = np.full((q, beam), -1, dtype=np.int32)
    dist = np.full((q, beam), 1 << 20, dtype=np.int32)
    open_ = np.zeros((q, beam), dtype=bool)
    seen = np.zeros((q, filled + 1), dtype=bool)
    width = min(len(entries), beam)
    first = distances(queries[:, None, :], points[entries][None])
    order = np.argsort(first, axis=1, kind="stable")[:, :width]
    ids[:, :width], dist[:, :width], open_[:, :width] = entries[order], np.take_along_axis(first, order, 1), True
    seen[:, entries] = True
    rows = np.arange(q)[:, None]
    for _ in range(4 * beam):
        live = open_.any(axis=1)
        if not live.any():
            break
        chosen = np.argsort(np.where(open_, dist, 1 << 21), axis=1, kind="stable")[:, :expand]
        usable = np.take_along_axis(open_, chosen, 1)
        np.put_along_axis(open_, chosen, False, 1)
        near = graph[np.where(usable, np.take_along_axis(ids, chosen, 1), -1)].reshape(q, -1)
        near = np.where((near >= 0) & (near < filled) & np.repeat(usable, graph.shape[1], axis=1), near, filled)
        fresh = ~seen[rows, near] & (near < filled)
        seen[rows, near] = True
        near = np.where(fresh, near, -1)
        d = np.where(fresh, distances(queries[:, None, :], points[near]), 1 << 20)
        both_ids, both_d = np.concatenate([ids, near], axis=1), np.concatenate([dist, d], axis=1)
        both_open = np.concatenate([open_, fresh], axis=1)
        keep = np.argsort(both_d, axis=1, kind="stable")[:, :beam]
        ids, dist, open_ = np.take_along_axis(both_ids, keep, 1), np.take_along_axis(both_d, keep, 1), np.take_along_axis(both_open, keep, 1)
        # a node met twice in one step stands twice: the second is closed
        again = np.concatenate([np.zeros((q, 1), dtype=bool), ids[:, 1:] == ids[:, :-1]], axis=1)
        open_ &= ~again & (ids >= 0)
    return ids, dist


def build(points: np.ndarray, degree: int = DEGREE, chunk: int = 512) -> np.ndarray:
    """Links (points x 2 degree, -1 for none): each point to its nearest earlier ones, and those back to it while they have room or it is nearer."""
    n, width = len(points), 2 * degree
    graph = np.full((n + 1, width), -1, dtype=np.int32)
    reach = np.full((n + 1, width), 1 << 20, dtype=np.int32)
    done = 0
    while done < n:
        stop = min(n, done + max(64, min(chunk, done)))
        block = points[done:stop]
        own = distances(block[:, None, :], block[None])
        own[np.triu_indices(stop - done)] = 1 << 20
        ids, dist = np.broadcast_to(np.arange(done, stop, dtype=np.int32), own.shape), own
        if done:
            far, far_d = walk(points, graph, block, 3 * degree, done)
            ids, dist = np.concatenate([far, ids], axis=1), np.concatenate([far_d, dist], axis=1)
        keep = np.argsort(dist, axis=1, kind="stable")[:, :degree]
        ids, dist = np.take_along_axis(ids, keep, 1), np.take_along_axis(dist, keep, 1)
        usable = (dist < 1 << 20) & (ids >= 0)
        graph[done:stop, : ids.shape[1]], reach[done:stop, : ids.shape[1]] = np.where(usable, ids, -1), np.where(usable, dist, 1 << 20)
        for source, target, d in zip(*(np.repeat(np.arange(done, stop), ids.shape[1])[usable.ravel()], ids[usable], dist[usable]), strict=True):
            worst = int(reach[target].argmax())
            if d < reach[target, worst]:
                graph[target, worst], reach[target, worst] = source, d
        done = stop
    return graph


def tuned_beam(points: np.ndarray, graph: np.ndarray, k: int = 10) -> int:
    """The narrowest beam whose recall of the k nearest within RADIUS reaches TARGET against exhaustive search on a sample."""
    sample = points[np.unique(np.linspace(0, len(points) - 1, min(len(points), SAMPLE)).astype(int))]
    exact = np.sort(distances(sample[:, None, :], points[None]), axis=1)[:, :k]
    for beam in BEAMS:
        found = walk(points, graph, sample, max(beam, k), len(points))[1][:, : exact.shape[1]]
        within = exact <= RADIUS
        if not within.any() or (found <= np.maximum(exact, 0))[within].mean() >= TARGET:
            return max(beam, k)
    return BEAMS[-1]


def compaction(batches: list[int], fan: int = 8) -> dict[int, int]:
    """Shard segment of each batch under level compaction: `fan` segments of a level are merged into one of the next."""
    out, start, n = {}, 0, len(batches)
    while start < n:
        size = 1
        while size * fan <= n - start:
            size *= fan
        for b in batches[start : start + size]:
            out[b] = batches[start]
        start += size
    return out


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo: dict[str, np.ndarray] = {}
    for batch in batches:
        if len(batch):
            s = np.stack([sketch(t, memo) for t in batch["title"]])
            yield pd.DataFrame({"id": batch["id"], "segment": batch["segment"], "s0": s[:, 0], "s1": s[:, 1]})


def _shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("id")
    points = rows[["s0", "s1"]].to_numpy(dtype=np.int64)
    graph = build(points)
    return pd.DataFrame({"segment": [key[0]], "part": [key[1]], "n": [len(rows)], "beam": [tuned_beam(points, graph)], "ids": [rows["id"].to_numpy(dtype=np.int64).tobytes()], "points": [points.tobytes()], "graph": [graph.tobytes()]})


SHARD_SCHEMA = "segment long, part int, n long, beam int, ids binary, points binary, graph binary"


def sketched(titles: DataFrame) -> DataFrame:
    """titles(id, segment, title) to (id, segment, s0, s1)."""
    known = titles.where("id is not null and segment is not null and trim(title) <> ''").select("id", "segment", "title")
    return known.mapInPandas(skip_empty(_sketches), "id long, segment long, s0 long, s1 long")


def build_index(points: DataFrame) -> DataFrame:
    """The shards of all segments, written; a large segment is spread over parts of at most about SHARD_ROWS rows."""
    sizes = points.groupBy("segment").agg(F.ceil(F.count("*") / F.lit(SHARD_ROWS)).cast("int").alias("parts"))
    placed = points.join(sizes, "segment").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    return cut(placed.select("id", "segment", "s0", "s1", "part").groupBy("segment", "part").applyInPandas(_shard, SHARD_SCHEMA), "shards")


def _search(exhaustive: bool, k: int, radius: int):
    @skip_empty
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids, points = np.frombuffer(row.ids, dtype=np.int64), np.frombuffer(row.points, dtype=np.int64).reshape(-1, 2)
                graph = np.frombuffer(row.graph, dtype=np.int32).reshape(len(ids) + 1, -1)
                asked = np.array(row.asked.tolist(), dtype=object)
                q_ids = np.array([a["id"] for a in asked], dtype=np.int64)
                q = np.array([[a["s0"], a["s1"]] for a in asked], dtype=np.int64)
                for start in range(0, len(q), 256):
                    part = q[start : start + 256]
                    if exhaustive:
                        d = distances(part[:, None, :], points[None])
                        at = np.argpartition(d, min(k, d.shape[1] - 1), axis=1)[:, : k + 1]
                        d = np.take_along_axis(d, at, 1)
                    else:
                        at, d = walk(points, graph, part, max(int(row.beam), k), len(points))
                    mine = np.repeat(q_ids[start : start + 256], at.shape[1])
                    theirs = ids[at.ravel()]
                    good = (at.ravel() >= 0) & (d.ravel() <= radius) & (mine != theirs)
                    yield pd.DataFrame({"id": mine[good], "neighbour": theirs[good], "distance": d.ravel()[good].astype(np.int32)})

    return run


def search(shards: DataFrame, queries: DataFrame, k: int = 10, exhaustive: bool = False, radius: int = RADIUS) -> DataFrame:
    """(id, neighbour, distance): the k nearest of each query row over all shards, within the radius; ties by neighbour.

    Queries stand in blocks, and every block visits every shard.
    """
    blocks = queries.select(F.pmod(F.xxhash64("id"), F.lit(max(1, -(-queries.count() // QUERY_BLOCK)))).alias("block"), F.struct("id", "s0", "s1").alias("q")).groupBy("block").agg(F.collect_list("q").alias("asked"))
    # a stated query set against all shards, in blocks: every shard has a slot of its own, so the visits are spread over as many tasks
    slots = max(1, shards.count())
    numbered = shards.withColumn("slot", F.pmod(F.xxhash64("segment", "part"), F.lit(slots)).cast("int"))
    visits = blocks.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    found = numbered.join(visits, "slot").select("ids", "points", "graph", "beam", "asked").mapInPandas(_search(exhaustive, k, radius), "id long, neighbour long, distance int").distinct()
    place = F.row_number().over(W.partitionBy("id").orderBy("distance", "neighbour"))
    return found.withColumn("_p", place).where(F.col("_p") <= k).drop("_p")


def rerank(found: DataFrame, titles: DataFrame) -> DataFrame:
    """found with `shared`, the exact share of common words of both titles (characters in Chinese), best first as `place`."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("title"), F.lit(r"([\x{3400}-\x{9fff}]|[\p{L}\p{N}&&[^\x{3400}-\x{9fff}]]+)"), F.lit(1)))
    side = titles.select("id", words.alias("w"))
    both = found.join(side.withColumnRenamed("w", "_a"), "id").join(side.select(F.col("id").alias("neighbour"), F.col("w").alias("_b")), "neighbour")
    shared = F.size(F.array_intersect("_a", "_b")) / F.greatest(F.size(F.array_union("_a", "_b")), F.lit(1))
    out = both.select("id", "neighbour", "distance", F.round(shared, 6).alias("shared"))
    return out.withColumn("place", F.row_number().over(W.partitionBy("id").orderBy(F.col("shared").desc(), "distance", "neighbour")))


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row (queries, expected, hits, recall): how many of the exact neighbours, or others as near, were found."""
    mine = found.groupBy("id", "distance").agg(F.count("*").alias("got"))
    want = exact.groupBy("id", "distance").agg(F.count("*").alias("due"))
    joined = want.join(mine, ["id", "distance"], "left").withColumn("hit", F.least("due", F.coalesce("got", F.lit(0))))
    return joined.agg(F.count_distinct("id").alias("queries"), F.coalesce(F.sum("due"), F.lit(0)).alias("expected"), F.coalesce(F.sum("hit"), F.lit(0)).alias("hits")).withColumn("recall", F.when(F.col("expected") > 0, F.round(F.col("hits") / F.col("expected"), 6)).otherwise(1.0))


def pair_recall(found: DataFrame, due: DataFrame) -> DataFrame:
    """One row (queries, expected, hits, recall): how many of the pairs due(id, neighbour) the search found."""
    joined = due.join(found.select("id", "neighbour", F.lit(1).alias("hit")).distinct(), ["id", "neighbour"], "left")
    return joined.agg(F.count_distinct("id").alias("queries"), F.count("*").alias("expected"), F.coalesce(F.sum("hit"), F.lit(0)).alias("hits")).withColumn("recall", F.when(F.col("expected") > 0, F.round(F.col("hits") / F.col("expected"), 6)).otherwise(1.0))
