import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from digestflow.llm import bitslice, nearcopies

VOCABULARY = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "po", "ra", "su", "te") for b in ("ban", "cor", "dif", "gel", "hum", "jap", "kel", "lim")]


def sentence(rng, n=60):
    return " ".join(rng.choice(VOCABULARY, n))


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 300), st.integers(0, 128), st.integers(0, 2**31))
def test_bit_sliced_distance_is_hamming_distance(pairs, radius, seed):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 256, (pairs, 16), dtype=np.uint8)
    b = a ^ (rng.integers(0, 256, (pairs, 16), dtype=np.uint8) & rng.integers(0, 256, (pairs, 16), dtype=np.uint8))
    assert (bitslice.within_radius(a, b, radius, words=2) == (np.bitwise_count(a ^ b).sum(axis=1) <= radius)).all()


def records(seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(60):
        words = sentence(rng).split()
        out.append(words)
        for _ in range(int(rng.integers(0, 3))):
            edited = list(words)
            for at in rng.choice(len(edited), int(rng.integers(0, 7)), replace=False):
                edited[at] = str(rng.choice(VOCABULARY))
            out.append(edited)
    return [(i, "t", " ".join(w)) for i, w in enumerate(out)]


def brute_groups(rows):
    shingles = []
    for _, t, b in rows:
        w = f"{t or ''} {b or ''}".lower().split()
        shingles.append({tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(shingles):
        for j in range(i):
            if a and shingles[j] and len(a & shingles[j]) >= 0.5 * len(a | shingles[j]):
                parent[find(i)] = find(j)
    return {(rows[j][0], rows[i][0]) for i in range(len(rows)) for j in range(i) if shingles[i] and find(i) == find(j)}


@pytest.mark.parametrize("block", [256, 3])
def test_pairs_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nearcopies, "BLOCK", block)
    rows = records() + [(1000, None, None), (1001, "", ""), (1002, "short", ""), (1003, "Short!", None)]
    df = spark.createDataFrame(rows, "ordinal long, title string, body string")
    got = {(r.ordinal_a, r.ordinal_b) for r in nearcopies.group_pairs(nearcopies.groups(df), block=2).collect()}
    assert got == brute_groups([(o, t, b) for o, t, b in rows if o != 1003]) | {(1002, 1003)}


def test_one_text_many_times_is_one_node(spark):
    df = spark.range(500).selectExpr("id as ordinal", "'Same title' as title", "'one two three four five six' as body")
    got = nearcopies.groups(df).groupBy("group_id").count().collect()
    assert [r["count"] for r in got] == [500]


def test_links_at_one_half_are_proposed(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(1000):
        own = rng.choice(2**32, 80, replace=False).astype(np.uint32)
        rows += [(2 * i, 2 * i + 1, np.sort(own[:60]).tobytes()), (2 * i + 1, 2 * i + 2, np.sort(own[20:]).tobytes())]
    found = nearcopies.links(spark.createDataFrame(rows, "ordinal long, text_key long, runs binary")).collect()
    assert all(r.a % 2 == 1 and r.b == r.a + 1 for r in found)
    assert len(found) >= 990


def test_empty(spark):
    df = spark.createDataFrame([], "ordinal long, title string, body string")
    assert nearcopies.group_pairs(nearcopies.groups(df)).count() == 0


@pytest.mark.parametrize("step", [1, 2, 63, 64, 65, 130])
def test_vertical_planes_against_counting(step):
    rng = np.random.default_rng(3)
    sketches = rng.integers(0, 256, (300, 16), dtype=np.uint8)
    sketches[::3] = sketches[0]
    asked = rng.random(300) < 0.5
    asked[-step:] = False
    near = bitslice.near_at(bitslice.planes(sketches), step, asked, 52)
    distance = np.bitwise_count(sketches[:-step] ^ sketches[step:]).sum(axis=1)
    assert (near[:-step] == (asked[:-step] & (distance <= 52))).all() and not near[-step:].any()
    across = bitslice.near_across(bitslice.planes(sketches), 300, bitslice.planes(sketches[:70]), 70, 52)
    assert (across == (np.bitwise_count(sketches[None] ^ sketches[:70, None]).sum(axis=2) <= 52)).all()


def test_large_buckets_are_packed_and_compared_in_cells(spark, monkeypatch):
    """Texts of one family fill their buckets beyond a block; cells give the links that one comparison in place gives."""
    rng = np.random.default_rng(4)
    common = rng.integers(1, 1 << 32, 60, dtype=np.uint32)
    rows = [(i, i + 1, np.unique(np.concatenate([common, rng.integers(1, 1 << 32, 20, dtype=np.uint32)])).tobytes()) for i in range(300)]
    df = spark.createDataFrame(rows, "ordinal long, text_key long, runs binary")
    packed = {(r.a, r.b) for r in nearcopies.links(df).collect()}
    exact = set()
    sets = [np.frombuffer(r[2], dtype=np.uint32) for r in rows]
    for i in range(300):
        for j in range(i + 1, 300):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both * 2 >= len(sets[i]) + len(sets[j]) - both:
                exact.add((i + 1, j + 1))
    assert packed <= exact and len(packed) >= 0.99 * len(exact) > 10_000
    recall = nearcopies.link_recall(df, nearcopies.links(df)).first()
    assert recall.queries == 15 and recall.recall >= 0.99


def test_text_of_a_third_of_all_rows_is_banded_once_a_task(spark):
    runs = np.arange(50, dtype=np.uint32).tobytes()
    df = spark.createDataFrame([(i, 7, runs) for i in range(5000)], "ordinal long, text_key long, runs binary").coalesce(1)
    assert df.select("text_key", "runs").mapInPandas(nearcopies._bands, "band long, text_key long, s0 long, s1 long").count() == nearcopies.BANDS


def test_min_hashes_of_many_texts_at_once():
    import numpy as np

    from digestflow.llm import nearcopies

    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 32, int(n), dtype=np.uint32)) for n in [1, 3, 700, 9_000, 2, 511, 1, 512, 513, *rng.integers(1, 90, 60)]]
    want = np.stack([nearcopies.min_hashes(s) for s in sets])
    assert (nearcopies.all_min_hashes(sets) == want).all() and (nearcopies.all_min_hashes(sets[3:4]) == want[3:4]).all()
    assert nearcopies.all_min_hashes([]).shape == (0, nearcopies.SKETCH_BITS)


def test_ascii_words_are_cut_as_by_character():
    import re

    from digestflow.llm import nearcopies

    words = nearcopies.WordHashes()
    every = "".join(map(chr, range(128)))
    for text in (every, every[::-1] + " a_b c-d\x1cE\x7f9", "___", ""):
        slow = " ".join(re.findall(r"[^\W_]+", text.lower()))
        assert nearcopies.runs(text, words)[0] == (nearcopies.xxhash.xxh64_intdigest(slow) >> 1 if slow else 0)


def test_runs_of_many_texts_at_once():
    import re

    def slow(text):
        text = text.lower()
        han = len(re.findall("[㐀-䶿一-鿿]", text)) * 4 > len(text)
        found = re.findall(r"[^\W_]+", text)
        units = [ord(c) for c in "".join(found)] if han else [nearcopies.xxhash.xxh64_intdigest(w) for w in found]
        out = set()
        for i in range(max(1, len(units) - 2) if units else 0):
            mixed = units[i]
            for u in units[i + 1 : i + 3]:
                mixed = (mixed * int(nearcopies._M1) + (u ^ int(nearcopies._M2))) % 2**64
            out.add(int(nearcopies._mix(np.array([mixed], dtype=np.uint64))[0]) >> 32)
        return sorted(out)

    rng = np.random.default_rng(6)
    texts = ["", "One", "one two", "İx K _y_", "模型", "模型 发布 新 模型发布", "...", "a b c a b c a b c", *(sentence(rng, int(n)) for n in rng.integers(1, 60, 40)), ""]
    for held in (1, 50, 100_000):
        found = [r for _, some in nearcopies.all_runs(texts, nearcopies.WordHashes(), held=held) for r in some]
        assert [r.tolist() for r in found] == [slow(t) for t in texts]


def test_band_rows_travel_packed_by_slot(spark):
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(i + 1, rng.integers(0, 1 << 32, 20, dtype=np.uint32).tobytes()) for i in range(300)], "text_key long, runs binary").coalesce(1)
    packed = df.mapInPandas(nearcopies._slotted(5), "slot int, rows binary").collect()
    assert sorted(r.slot for r in packed) == [0, 1, 2, 3, 4]  # not one row for each text and band
    rows = np.concatenate([np.frombuffer(r.rows, dtype=np.int64).reshape(-1, 4) for r in packed])
    assert all((np.frombuffer(r.rows, dtype=np.int64).reshape(-1, 4)[:, 0] % 5 == r.slot).all() for r in packed)
    plain = df.mapInPandas(nearcopies._bands, "band long, text_key long, s0 long, s1 long").collect()
    assert sorted(map(tuple, rows.tolist())) == sorted(map(tuple, plain)) and len(rows) == 300 * nearcopies.BANDS


@pytest.mark.parametrize(("held", "piece", "cell"), [(4_000_000, 200_000, 1_024), (4_000_000, 7, 1_024), (400, 50, 2)])
def test_a_bucket_that_piles_up_goes_out_in_blocks(monkeypatch, held, piece, cell):
    import pyarrow as pa

    monkeypatch.setattr(nearcopies, "HELD", held)
    monkeypatch.setattr(nearcopies, "PIECE", piece)
    monkeypatch.setattr(nearcopies, "CELL", cell)
    rng = np.random.default_rng(8)
    sketches = rng.integers(0, 1 << 62, (900, 2), dtype=np.int64)
    sketches[::2] = sketches[0]
    band = np.where(np.arange(900) < 500, 3, rng.integers(10, 40, 900))
    rows = np.column_stack([band, np.arange(1, 901), sketches])
    rows = rng.permutation(np.concatenate([rows, rows[100:130], rows[880:]]))
    batches = [pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in np.array_split(some, 3)], pa.binary())], names=["rows"]) for some in np.array_split(rows, 10)]
    out = pa.Table.from_batches(nearcopies._buckets(iter(batches))).to_pandas()
    got = set(map(tuple, out[out["keys"].isna()][["a", "b"]].to_numpy().tolist()))
    blocks = out[out["keys"].notna()]
    assert set(blocks["band"]) == {3}
    assert set(np.concatenate([np.frombuffer(k, dtype=np.int64) for k in blocks["keys"]]).tolist()) == set(range(1, 501))
    want = set()
    for b in set(band) - {3}:
        at = np.flatnonzero(band == b)
        near = np.bitwise_count(sketches[at][:, None] ^ sketches[at][None]).sum(axis=2) <= nearcopies.RADIUS
        want |= {(int(at[i]) + 1, int(at[j]) + 1) for i, j in zip(*np.nonzero(near), strict=True) if i < j}
    assert got == want


def test_digests_in_the_task_that_marks_lines(items):
    from digestflow.llm import pages

    df = items([(i, "s", f"Title {i}", f"Some words of text {i % 3} here.\nAnd a line more.") for i in range(30)])
    want = nearcopies.digests(pages.main_bodies(df)).collect()
    got = pages.main_bodies(df, then=nearcopies._digest, schema=nearcopies.DIGESTS).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 30
