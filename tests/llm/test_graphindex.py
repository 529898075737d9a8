import numpy as np

from digestflow.llm import graphindex as g

WORDS = "amber basil cedar delta ember fjord grove heath inlet joust krill lumen maple north ocean pixel".split()


def titles(n, seed=4):
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        words = [f"{a}{rng.integers(50)}" for a in rng.choice(WORDS, 9)]
        out.append(" ".join(words))
        if rng.random() < 0.4:
            words[int(rng.integers(9))] = "other"
            out.append(" ".join(words))
    return out[:n]


def test_walk_reaches_the_neighbours_of_exhaustive_search():
    memo = {}
    points = np.stack([g.sketch(t, memo) for t in titles(3000)])
    graph = g.build(points)
    beam = g.tuned_beam(points, graph)
    exact = np.sort(g.distances(points[:, None, :], points[None]), axis=1)[:, :5]
    found = np.concatenate([g.walk(points, graph, points[i : i + 500], beam, len(points))[1][:, :5] for i in range(0, 3000, 500)])
    within = exact <= g.RADIUS
    assert (found <= exact)[within].mean() >= 0.95


def test_compaction_merges_full_levels():
    plan = g.compaction(list(range(21)), fan=4)
    assert [plan[b] for b in (0, 15, 16, 19, 20)] == [0, 0, 16, 16, 20] and g.compaction([]) == {}


def test_search_recall_and_rerank(spark, monkeypatch):
    monkeypatch.setattr(g, "SHARD_ROWS", 300)
    rows = [(i, i // 400, t, "x") for i, t in enumerate(titles(1200))] + [(5000, 1, None, "x"), (5001, 1, " ", "x"), (None, 1, "t", "x"), (5002, None, "t", "x"), (5003, 0, titles(1200)[0], "x")]
    df = spark.createDataFrame(rows, "id long, segment long, title string, beam string")
    points = g.sketched(df).cache()
    shards = g.build_index(points)
    assert shards.selectExpr("sum(n) as n").first().n == 1201 and shards.count() > 4
    asked = points.where("id % 20 = 0")
    found = g.search(shards, asked)
    assert g.recall(found, g.search(shards, asked, exhaustive=True)).first().recall >= 0.9
    best = {r.id: r for r in g.rerank(found, df).where("place = 1").collect()}
    assert best[0].neighbour == 5003 and best[0].shared == 1.0


def test_empty(spark):
    df = spark.createDataFrame([], "id long, segment long, title string")
    points = g.sketched(df)
    shards = g.build_index(points)
    assert g.rerank(g.search(shards, points), df).count() == 0 and g.recall(g.search(shards, points), g.search(shards, points)).first().recall == 1.0
