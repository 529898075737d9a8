import datetime as dt

import pandas as pd

from digestflow.llm import batches, historyindex

D = [dt.datetime(2025, 9, d, 10) for d in (15, 16, 17)]
NAMES = ["lumen ledger"]


def names(spark, values=NAMES):
    return spark.createDataFrame([(n,) for n in values], "name string")


def known(spark, items, rows, urls=(), titles=()):
    hu = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "entry_id long, url string, target_date date")
    ht = spark.createDataFrame([(i, t, None) for i, t in enumerate(titles)], "entry_id long, title string, target_date date")
    df = items([(i, "s", t, "", u, d) for i, (t, u, d) in enumerate(rows)])
    return sorted(r.ordinal for r in batches.known_rows(df, hu, ht, names(spark)).collect())


FILL = [(f"Why Nam{chr(97 + i)}ola tightens its open ledger before the audit review", f"https://x.example/f{i}", D[0]) for i in range(4)]


def test_urls(spark, items):
    rows = [("Alpha beta gamma delta", "https://a.example/p", D[0]), ("Other words entirely here", "HTTPS://WWW.A.example//p/?utm_source=z#top", D[1]), ("Third thing stands alone", "https://a.example/P", D[1])]
    assert known(spark, items, rows) == [1]


def test_titles_with_one_replaced_or_misspelt_word(spark, items):
    base = "How Zodup Labs hardens open ledger with Kavimora"
    rows = [
        (base, "https://a.example/1", D[0]),
        ("[Exclusive] How Zodup Labs hardens open ledegr with Kavimora | Lumen Ledger", "https://a.example/2", D[1]),
        ("HOW ZODUP LABS: tightens open ledger, with Kavimora!", "https://a.example/3", D[1]),
        ("How Zodup Labs hardens open ledger with Brunotek", "https://a.example/4", D[1]),
        ("How Zodup Labs hardens every open ledger with Kavimora", "https://a.example/5", D[1]),
    ]
    assert known(spark, items, rows + FILL) == [1, 2]


def test_versions_are_other_stories(spark, items):
    rows = [("Release 2.1 of Kavimora opens the ledger", "https://a.example/1", D[0]), ("Release 2.2 of Kavimora opens the ledger", "https://a.example/2", D[1])]
    assert known(spark, items, rows) == []


def test_chinese_terms(spark, items):
    rows = [("克达科技围绕Kavimora提升分布式客服系统和翻译器", "https://a.example/1", D[0]), ("【更新】克达科技围绕Kavimora提升轻量客服系统和翻译器", "https://a.example/2", D[1]), ("克达科技围绕Brunotek提升分布式客服系统和翻译器", "https://a.example/3", D[1])]
    assert known(spark, items, rows) == [1]


def test_chinese_terms_of_other_length_without_latin_words(spark, items):
    left, right = "克达科技今天上午宣布围绕", "客服系统和翻译器"
    rows = [(left[-10:] + "提升" + right + "一", "https://a.example/1", D[0]), (left[-10:] + "全面降低" + right + "一", "https://a.example/2", D[1])]
    assert [len(t) for t, _, _ in rows] == [21, 23] and known(spark, items, rows) == [1]


def test_titles_that_share_a_slot_share_a_half():
    han = [chr(0x4E00 + i) for i in range(400)]
    for total in (10, 21, 40, 70):
        for at in range(total):
            for a in range(1, batches.MAX_TERM + 1):
                for b in range(1, batches.MAX_TERM + 1):
                    pair = ["".join([*han[:at], *han[100 + 100 * k : 100 + 100 * k + n], *han[at:total]]) for k, n in enumerate((a, b))]
                    keys = next(batches._halves(iter([pd.DataFrame({"title_node": [1, 2], "units": pair})])))
                    assert keys.groupby("half").title_node.nunique().max() == 2


def test_history_chains_and_own_batch(spark, items):
    rows = [("Quiet title of one story", "https://a.example/1", D[1]), ("Another headline for that page", "https://a.example/1", D[1]), ("Same batch only story here", "https://a.example/8", D[2]), ("Same batch only story here", "https://a.example/9", D[2])]
    assert known(spark, items, rows) == []
    assert known(spark, items, rows, urls=["http://b.example/x"], titles=["Quiet title of one story", None, ""]) == [0, 1]
    assert known(spark, items, rows, urls=["https://www.a.example/9/"]) == [2, 3]


def test_nulls_and_empty(spark, items):
    rows = [(None, None, D[0]), ("", " ", D[1]), (None, "https://a.example/1", D[0]), ("Some title with five words", None, D[0]), ("Some title with five words", "https://a.example/1", D[1])]
    assert known(spark, items, rows) == [4]
    assert known(spark, items, []) == []


def test_short_titles_link_too(spark, items):
    rows = [
        ("Zodup hardens caches", "https://a.example/1", D[0]), ("Zodup hardens cahces", "https://a.example/2", D[1]), ("Qurel opens", "https://a.example/3", D[0]), ("Qurel opnes", "https://a.example/4", D[1]),
        ("Kavimorax", "https://a.example/5", D[0]), ("Kavmorax", "https://a.example/6", D[1]), ("Trelopin", "https://a.example/7", D[1]), ("小模型开源", "https://a.example/8", D[0]), ("大模型开源", "https://a.example/9", D[1]), ("Totally", "https://a.example/10", D[1]),
    ]
    assert known(spark, items, rows) == [1, 3, 5, 8]


def test_site_names_are_joined_where_they_are_many(spark, items):
    df = items([(0, "s", "Alpha Beta - Gamma opens | Some Wire", "", None, D[0]), (1, "s", "Plain - Some", "", None, D[0])]).select("ordinal", batches.F.lit(1).cast("long").alias("day"), batches.F.lit(0).cast("long").alias("url_node"), "title")
    sites = names(spark, ["some wire", "other", "gamma opens"])
    few, many = (sorted((r.ordinal, r.units) for r in batches.normalised(df, sites, limit).collect()) for limit in (10, 0))
    assert few == many == [(0, "alpha beta gamma opens"), (1, "plain some")]


def test_appending_equals_building_at_once(spark, items, tmp_path):
    """Batches appended to a stored index give what one build gives; older segments stay as they are; compaction changes no answer."""
    base = "How Zodup Labs hardens open ledger with Kavimora"
    rows = [(i, "s", t, "", u, d) for i, (t, u, d) in enumerate([
        *FILL, (base, "https://a.example/1", D[0]), ("Other story entirely about nothing else here", "https://b.example/1", D[0]),
        (base.replace("ledger", "ledegr"), "https://a.example/2", D[1]), ("A lonely title that stands by itself today", "https://c.example/1", D[1]), ("Second lonely title that nobody wrote before", "https://c.example/2", D[1]),
        ("A lonely title that stands by itself today!", "https://h.example/old", D[2]), ("Second lonely title that nobody wrote before", "https://d.example/9", D[2]),
    ])]
    hu = spark.createDataFrame([(0, "https://h.example/old", None)], "entry_id long, url string, target_date date")
    ht = spark.createDataFrame([(0, "Entirely unrelated headline of the past days", None)], "entry_id long, title string, target_date date")
    everything, sites = items(rows), names(spark)
    words = batches.ordinary_words(everything.select(batches.F.col("title").alias("plain")))
    whole = {r.ordinal for r in batches.known_rows(everything, hu, ht, sites, words).collect()}
    index = historyindex.HistoryIndex(spark, str(tmp_path / "index"), sites, buckets=2)
    got = {r.ordinal for r in index.create(everything.where(f"date(discovered_at) = '{D[0].date()}'"), hu, ht, words).collect()}
    before = {p: p.read_bytes() for p in sorted((tmp_path / "index").rglob("*.parquet"))}
    for d in D[1:]:
        found, revised, report = index.append(everything.where(f"date(discovered_at) = '{d.date()}'"))
        got |= {r.ordinal for r in found.collect()} | {r.ordinal for r in revised.collect()}
        assert report["titles_opened"] <= report["titles_stored"]
    assert got == whole and 7 in whole  # row 7 became known by a row of the last day that shares its title and a page of the history
    assert all(p.read_bytes() == data for p, data in before.items())
    places = sorted(map(tuple, index.read("places").collect()))
    assert len(index.compact(fan=3)) == 3 and len(index.manifest()["segments"]) == 1 and sorted(map(tuple, index.read("places").collect())) == places
    found, _, _ = index.append(items([(90, "s", base.replace("Labs", "Lbas"), "", None, dt.datetime(2025, 9, 20)), (91, "s", None, "", None, dt.datetime(2025, 9, 20))]))
    assert [r.ordinal for r in found.collect()] == [90]
    assert index.append(items([]))[2]["rows"] == 0
