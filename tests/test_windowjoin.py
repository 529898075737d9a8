import random
from decimal import Decimal

import numpy as np
import pytest

from digestflow.operators import linkage, windowjoin
from digestflow.operators.components import connected_components, forest
from digestflow.session import fresh_folder

SCHEMA = "ordinal long, at long, tokens array<string>, source string, release boolean, ids array<string>"


def pairs_of(rows, jaccard, containment, window):
    """The pairs by comparing all, with multiplicity, in exact decimals."""
    out = []
    for a, ta, x, sa, ra, ia in rows:
        for b, tb, y, sb, _, ib in rows:
            if a is None or b is None or not a < b or ta is None or tb is None or abs(ta - tb) > window:
                continue
            common, least = len(set(x) & set(y)), min(len(x), len(y))
            close = least > 0 and common >= Decimal(jaccard) * (len(x) + len(y) - common) and common >= Decimal(containment) * least
            if set(ia) & set(ib) or (close and not ((ra or ra is None) and (sa == sb or sa is None or sb is None))):
                out.append((a, b, common, len(x), len(y)))
    return sorted(out)


def some_rows(vocabulary, seed=3, n=260):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    rows = []
    for i in range(n):
        tokens = sorted({str(w) for w in rng.choice(words, int(rng.integers(0, 14)))}) if i % 3 or not rows else sorted(set(rows[-1][2][1:]) | {f"x{i % 7}"})
        ids = sorted({f"cve-{int(k)}" for k in rng.integers(0, 25, int(rng.integers(0, 3)))}) if i % 5 == 0 else []
        rows.append((None if i == 7 else i - i % 40 // 39, None if i == 9 else int(rng.integers(-60, 60)), tokens, [None, "a", "b", "c"][i % 4], [None, True, False][i % 3], ids))
    long = [f"l{i}" for i in range(100)]
    return [*rows, (n, 1, long, "z", False, []), (n + 1, 2, long[:55], "z", False, []), (n + 2, 50, long[:54], "z", False, [])]


@pytest.mark.parametrize(("vocabulary", "held", "indexed"), [(25, None, 6), (25, 30, 10**9), (4_000, None, 6), (4_000, 30, 0), (25, 12, 0)])
def test_window_join_equals_comparison_of_all(spark, monkeypatch, vocabulary, held, indexed):
    rows = some_rows(vocabulary)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name, value in {"INDEXED": indexed, "HITS": 50, "ROWS": 16, "OTHERS": 24, "AT_ONCE": 32}.items():
        monkeypatch.setattr(windowjoin, name, value)
    want = pairs_of(rows, "0.38", "0.55", 20)
    got = windowjoin.self_pairs(df, 0.38, 0.55, 20, held).collect()
    assert sorted(map(tuple, got)) == want and len(want) > 20
    assert windowjoin.self_pairs(df.limit(0), 0.38, 0.55, 20).count() == 0


def test_join_in_one_process(monkeypatch):
    """The same with small blocks, without workers, so that all limits are met."""
    import pyarrow as pa

    rng = np.random.default_rng(8)
    rows = [(i, int(rng.integers(0, 20)), sorted({int(k) for k in rng.integers(0, 30, int(rng.integers(1, 12)))})) for i in range(120)] + [(500 + i, 5, list(range(1000, 1000 + 256 * 260, 256)) + [i]) for i in range(3)]
    rows.sort(key=lambda r: r[1])
    table = pa.table({"slot": [0] * len(rows), "part": pa.array([0] * len(rows), pa.int32()), "role": pa.array([0] * len(rows), pa.int32()), "at": [r[1] for r in rows], "ordinal": [r[0] for r in rows], "source": [1] * len(rows), "release": [False] * len(rows), "ids": pa.array([[]] * len(rows), pa.list_(pa.int64())), "hashes": pa.array([r[2] for r in rows], pa.list_(pa.int64()))})
    want = pairs_of([(o, t, x, "", False, []) for o, t, x in rows], "0.38", "0.55", 6)
    for indexed in (0, 10**9):
        for name, value in {"INDEXED": indexed, "HITS": 50, "ROWS": 16, "OTHERS": 24, "AT_ONCE": 32}.items():
            monkeypatch.setattr(windowjoin, name, value)
        got = [tuple(r.values()) for b in windowjoin._join(0.38, 0.55, 6)(iter(table.to_batches(max_chunksize=17))) for r in b.to_pylist()]
        assert sorted(got) == want and len(want) > 30


def test_forest_keeps_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(None, 3), (5, 5)] + [(7, k) for k in range(400, 460)] * 12
    df = spark.createDataFrame(edges, "a long, b long").repartition(3)
    for held in (1, 40, 1_000_000):
        less = forest(df, held)
        assert set(map(tuple, connected_components(less).collect())) == set(map(tuple, connected_components(df).collect()))
    assert forest(df).count() < df.count() / 1.5


def folder_bytes(spark):
    from pathlib import Path

    root = Path(fresh_folder(spark, "x")).parent
    return {p: p.stat().st_size for p in root.rglob("*.parquet")}


def test_pairs_write_nothing_and_groups_no_texts(spark):
    """What the steps leave on the shared disk: before, posting candidates and whole items."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40)]
    hours = 3_600_000_000
    rows = [(i, f"s{i % 9}", "news", " ".join(rng.sample(words, 12)), " ".join(rng.choice(words) for _ in range(300)), rng.randrange(90) * hours, 0, f"https://e.example/{i - i % 2}") for i in range(600)]
    df = spark.createDataFrame(rows, "ordinal long, source string, source_channel string, title string, summary string, published_us long, discovered_us long, page string")
    before = folder_bytes(spark)
    pairs = linkage.similar_pairs(df)
    assert pairs.count() > 0 and folder_bytes(spark).keys() == before.keys()
    linkage.story_groups(df).count()
    assert sum(v for p, v in folder_bytes(spark).items() if p not in before) < 100_000


def test_events_move_no_texts(spark):
    """The join of items and groups carries the length of a summary, not the summary."""
    schema = "ordinal long, source string, source_tier string, source_channel string, source_time_kind string, published_us long, page string, title string, summary string"
    df = spark.createDataFrame([(1, "a", "A", "news", "published", 5, "p", "t", "long text")], schema)
    plan = linkage.events(df, spark.createDataFrame([(1, 1)], "ordinal long, story long"))._jdf.queryExecution().optimizedPlan()

    def nodes(node):
        yield node
        for k in range(node.children().size()):
            yield from nodes(node.children().apply(k))

    joins = [n for n in nodes(plan) if n.nodeName() == "Join"]
    assert joins and not any("summary#" in n.output().mkString(",") for n in joins)
