"""Connected components of an edge list by alternating large-star and small-star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestflow.session import cut, discard


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
    return both.join(least, F.col("u") == F.col("_u")).where("v > u").select(F.col("v").alias("u"), F.least("u", "_m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
    moved = edges.join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return moved.unionByName(least.select(F.col("_u").alias("u"), F.col("_m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges(a, b) of comparable ids to (node, component): each node that has an edge to another, with the least id of its component.

    Every round is two aggregations with map-side combine and two equi-joins, cut in the shared folder; the number of rounds is
    logarithmic in the longest path. Null ends and loops are ignored; an empty edge list gives no rows.
    """
    current = cut(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        following = cut(_small_star(_large_star(current)), "edges")
        mark = following.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(current)
        current = following
        if mark == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = mark
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def _contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for all nodes but the least."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while len(u):
        x, y = label[u], label[v]
        apart = x != y
        u, v, x, y = u[apart], v[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(further := label[label], label):
            label = further
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[other], nodes[label[other]]


def forest(edges: DataFrame, held: int = 1_000_000) -> DataFrame:
    """edges(a, b) of whole numbers with fewer edges and the same components: each task contracts up to `held` edges at a time to one for each node but the least of a component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            parts.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= held:
                parts = [_contracted(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
                size = len(parts[0][0])
                if 2 * size > held:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], names=["a", "b"])
                    parts, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _contracted(*(np.concatenate(x) for x in zip(*parts, strict=True)))], names=["a", "b"])

    return edges.where("a is not null and b is not null").select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(run, "a long, b long")
