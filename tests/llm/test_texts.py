import numpy as np
import pytest

from digestflow.llm import lookalikes, mixing, mojibake, tokens, truncation


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("ｅｌａｓｔｉｃ cache", "elastic cache"), ("chесkpoint", "checkpoint"), ("ran­ker", "ranker"), ("𝐜𝐚𝐮𝐬𝐚𝐥", "causal"), ("scaﬀold", "scaffold"), ("étude", "étude"),
        ("three weeks", "three weeks"), ("３1项", "31项"), ("通⽤", "通用"),
        ("“Quoted” – text…", "“Quoted” – text…"), ("👩‍💻 and 🚀", "👩‍💻 and 🚀"), ("β-test of μ-kernels", "β-test of μ-kernels"), ("Вектор is Russian", "Вектор is Russian"), ("中文，标点。", "中文，标点。"), ("naïve café", "naïve café"),
    ],
)
def test_table(text, want):
    assert lookalikes.by_table(text) == want


def test_trie_reads_lookalikes_at_no_cost():
    trie = lookalikes.Trie({"checkpoint": 5, "The": 9, "ranker": 2})
    spelled = lambda t: trie.spelling(t)[0]
    assert spelled("chесkpоint") == "checkpoint" and spelled("Тhе") == "The" and spelled("ran\u200bker") == "ranker"
    assert trie.ends("chockpoint") == {} and spelled("Ｎｅｗ") == "New" and trie.spelling("Ｎｅｗ")[1] is None


def test_automaton_weighs_its_steps():
    trie = lookalikes.Trie({"cafe": 50, "café": 1, "token": 3, "hoc": 9, "нос": 1})
    assert trie.spelling("cafe\u0301") == ("café", 0.0)  # a split accent read whole is cheaper than one dropped
    assert trie.spelling("тoken") == ("token", lookalikes.LOOSE)  # a loose look-alike costs something, and the table would have left it
    assert trie.spelling("нoс") == ("нос", 0.0)  # a Latin letter inside a Cyrillic word
    assert trie.ends("tokem") == {} and lookalikes.by_table("тoken") == "тoken"
    assert lookalikes.odd_tokens("Вектор agent ＡＩ ran\u00adker ☀️ naïve") == ["ＡＩ", "ran\u00adker"]


def test_canonical_rows(spark):
    rows = [("raw_items", 1, "The chесkpoint moves"), ("raw_items", 2, "The checkpoint moves"), ("claims", 1, "a​b"), ("claims", 2, None), ("claims", 3, ""), ("claims", None, "ｘ"), ("claims", 4, "ｘ" * 300_000)]
    df = spark.createDataFrame([(*r, "e") for r in rows], "rec_table string, ordinal long, text string, token string")
    got = {(r.rec_table, r.ordinal): r.canonical for r in lookalikes.canonical_texts(df).collect()}
    assert got == {("raw_items", 1): "The checkpoint moves", ("claims", 1): "ab", ("claims", 4): "x" * 300_000}
    assert lookalikes.canonical_texts(df.limit(0)).count() == 0


def test_twins_known_to_the_automaton_alone(spark):
    rows = ["The cheсkpoinт of schedulıng loɡs", "The checkpoint of scheduling logs", "scheduling", "кот и тигр", "kapı kapı kapi", "чекpoint"]
    df = spark.createDataFrame([("raw_items", i, t) for i, t in enumerate(rows)], "rec_table string, ordinal long, text string")
    got = {r.ordinal: r.canonical for r in lookalikes.canonical_texts(df).collect()}
    assert got == {0: "The checkpoint of scheduling logs"}


def test_truncation_on_held_out_cuts(spark):
    rng = np.random.default_rng(5)
    words = "the cache router ledger moves lowers older open digest every one budget before review".split()
    whole = [" ".join(rng.choice(words, 14)).capitalize() + "." for _ in range(400)]
    cut = [w[: int(rng.integers(20, len(w) - 6))].rstrip() + str(rng.choice(["", "…", " [...]"])) for w in whole[:60]]
    rows = [("raw_items", i, "s", t) for i, t in enumerate([*whole, *cut, "- an item of a list", "Tags: one, two", "— the Night desk", "", "  ", None])]
    got = {r.ordinal: r.truncated for r in truncation.score(spark.createDataFrame(rows, "rec_table string, ordinal long, source string, text string")).collect()}
    assert sum(got[i] for i in range(400)) == 0 and sum(got[i] for i in range(400, 460)) >= 59 and not any(got[i] for i in (460, 461, 462)) and 463 not in got


def test_long_items_and_tag_lines_are_complete(spark):
    rng = np.random.default_rng(5)
    words = "the cache router ledger moves lowers older open digest every one budget before review".split()
    whole = [" ".join(rng.choice(words, 14)).capitalize() + "." for _ in range(200)]
    long = " ".join(rng.choice(words, 90))
    rows = [("raw_items", i, "s", t) for i, t in enumerate([*whole, "- " + long, "Tags: " + long, long, "Whole." + " " * 300])]
    got = {r.ordinal: r.truncated for r in truncation.score(spark.createDataFrame(rows, "rec_table string, ordinal long, source string, text string")).collect()}
    assert [got[i] for i in range(200, 204)] == [False, False, True, False]


def test_truncation_empty(spark):
    assert truncation.score(spark.createDataFrame([], "rec_table string, ordinal long, source string, text string")).count() == 0


def test_long_words_contract_as_the_library_does():
    import tiktoken

    path, pattern = tokens.default_vocabulary()
    ranks = tokens.load_ranks(path)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(8)
    for word in ("a" * 3000, "".join(rng.choice(list("abcdefgh"), 2500)), "ü字" * 700, "x"):
        assert tokens.contract(word.encode(), ranks) == library.encode_ordinary(word) or not library.encode_ordinary(word)


TEXTS = ["Hello, world's 42 tests", "", None, "  spaced\n\n out\t", "中文和 English 混排，标点。", "náive 👩‍💻", "a" * 5000, "<|endoftext|>", "über façade", " 　﻿"]


def test_ids_equal_the_library_and_round_trip(spark):
    import tiktoken

    path, pattern = tokens.default_vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=tokens.load_ranks(path), special_tokens={})
    df = spark.createDataFrame([(i, t, "en", "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, ids string")
    encoded = tokens.encode_documents(df)
    got = {r.doc_id: r.ids for r in encoded.collect()}
    assert got == {i: library.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.text for r in tokens.decode_documents(encoded).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert tokens.encode_documents(df.limit(0)).count() == 0
    assert tokens.round_trip(df).first().changed == 0


def brute_mix(docs, target, budget):
    """The queue served copy by copy: least finish time first."""
    queue = []
    for source, (share, most) in target.items():
        own = [d for d in docs if d[1] == source and d[2] > 0]
        at = 0
        for copy in range(most):
            for d in own:
                at += d[2]
                queue.append((at / share, source, d[0], copy, d[2]))
    total, out = 0, {}
    for _, _, doc, _, size in sorted(queue):
        total += size
        if total > budget:
            break
        out[doc] = out.get(doc, 0) + 1
    return out


def test_mix_serves_the_queue(spark):
    rng = np.random.default_rng(1)
    docs = [(i, str(rng.choice(["a", "b", "c"], p=[0.7, 0.2, 0.1])), int(rng.integers(0, 60))) for i in range(400)]
    order = {r.doc_id: (r.k & (2**64 - 1), r.k) for r in spark.createDataFrame(docs, "doc_id long, source string, tokens long").selectExpr("doc_id", "xxhash64(7, doc_id) k").collect()}
    bucket = lambda d: ((order[d[0]][1] >> 40) % 256, order[d[0]][1], d[0])
    target = {"a": (0.5, 1), "b": (0.25, 4), "c": (0.25, 3)}
    whole = sum(d[2] for d in docs)
    targets = spark.createDataFrame([("m", s, w, n, 0.6) for s, (w, n) in target.items()], "mix_name string, source string, target_share double, max_repeat int, total_ratio double")
    mixed = mixing.mix(spark.createDataFrame(docs, "doc_id long, source string, tokens long"), targets)
    got = {r.doc_id: r.repeats for r in mixed.collect()}
    assert got == brute_mix(sorted(docs, key=bucket), target, 0.6 * whole)
    assert max(got.values()) <= 4
    shares = {r.source: r.actual_share for r in mixing.shares(mixed, targets).collect()}
    assert abs(sum(shares.values()) - 1) < 1e-5 and abs(shares["a"] - 0.5) < 0.05


def test_mix_of_nothing(spark):
    targets = spark.createDataFrame([("m", "a", 1.0, 2, 0.5)], "mix_name string, source string, target_share double, max_repeat int, total_ratio double")
    for rows in ([], [(1, "a", 0), (2, None, 5)]):
        mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, tokens long"), targets)
        assert mixed.count() == 0 and mixing.shares(mixed, targets).first().actual_share == 0.0


CLEAN = ["Während der Prüfung blieb die Stückliste „offen“ – größer.", "It’s a naïve “café” résumé… ATENÇÃO: NÃO MUDA ANTES DA REVISÃO.", "Команда проверила 192 моделей и обновила поиск.", "离线日志在多个城市收紧网关，成本下降。", "plain ascii only"]


def garble(text, right, wrong):
    return text.encode(right).decode(wrong)


def test_garbled_documents_are_found_and_restored(spark):
    bad = [
        (garble(CLEAN[0], "utf-8", "latin-1"), CLEAN[0]), (garble(CLEAN[0], "cp1252", "cp850"), CLEAN[0]), (garble(CLEAN[2], "utf-8", "cp1251"), CLEAN[2]), (garble(CLEAN[2], "koi8_r", "cp1251"), CLEAN[2]),
        (garble(CLEAN[3], "gbk", "latin-1"), CLEAN[3]), (garble(garble(CLEAN[0], "utf-8", "latin-1"), "utf-8", "latin-1"), CLEAN[0]), ("broken � text", None),
    ]
    rows = [(i, "s", t) for i, t in enumerate(CLEAN * 30)] + [(1000 + i, "s", g) for i, (g, _) in enumerate(bad)] + [(2000, None, None), (2001, "s", ""), (None, "s", bad[0][0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, text string, chain string")
    assert {r.doc_id for r in mojibake.garbled_documents(df).collect()} == {1000 + i for i in range(len(bad))}
    restored = {r.doc_id: r.repaired for r in mojibake.repaired_documents(df).collect() if r.restored}
    assert restored == {1000 + i: want for i, (_, want) in enumerate(bad) if want}
    assert mojibake.garbled_documents(df.limit(0)).count() == 0
