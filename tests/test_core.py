import random

import pytest
from pyspark.sql import functions as F

from digestflow.functions import html, text, urls
from digestflow.operators import linkage, ranking
from digestflow.operators.components import connected_components
from digestflow.sources import feeds
from digestflow.streaming import facades


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTPS://WWW.Example.com//post//?utm_source=x&a=1#top", "https://example.com/post?a=1"), ("https://e.com", "https://e.com/"), ("https://e.com/", "https://e.com/"), ("https://u:p@e.com:8080/A/?ref=z", "https://e.com:8080/A"),
        ("e.com/p", "https://e.com/p"), ("https://e.com/p?b&FBCLID=1&c=", "https://e.com/p?b=&c="), (None, None),
    ],
)
def test_canonical_url(spark, url, want):
    assert one(spark, urls.canonical_url(F.lit(url).cast("string"))) == want


def test_domains_and_fetch_guard(spark):
    domain = lambda u: one(spark, urls.registrable_domain(F.lit(u)))
    assert [domain(u) for u in ("https://news.a.co.uk/x", "https://www.b.example/", "https://c.d.e.com.cn", "https://co.uk", "nothing")] == ["a.co.uk", "b.example", "e.com.cn", "co.uk", None]
    fine = lambda u: one(spark, urls.allowed_fetch(F.lit(u)))
    assert fine("https://a.example/") and not any(fine(u) for u in ("http://a.example", "https://u@a.example", "https://localhost/", "https://10.0.0.1/", "https://192.168.1.1/", "https://172.20.0.1/"))


def test_tokens_and_identifiers(spark):
    assert sorted(one(spark, text.title_tokens(F.lit("The NEW model-7B v2.5 智能体发布 发布")))) == sorted(["model-7b", "v2.5", "智能", "能体", "体发"])
    assert one(spark, text.product_ids(F.lit("Alpha v2 beta 7b 7B"))) == ["7b", "v2"]
    assert one(spark, text.story_ids(F.lit("see CVE-2024-1234 and ghsa-ab-12, xCVE-2020-1"))) == ["cve-2024-1234", "ghsa-ab-12"]
    assert one(spark, text.normalize_quote(F.lit("他说：“ 好　的 ”，\n对！"))) == '他说:"好的",对!'
    assert one(spark, text.shortened(F.lit("a  b\n" + "c" * 200), 5)) == "a b c…"


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(None, 3), (5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    want = {n: find(n) for n in parent}
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def items(spark, rows):
    """(ordinal, source, channel, title, summary, hours)."""
    full = [(o, s, c, t, x, h * 3_600_000_000, 0, f"https://{s}.example/{o}") for o, s, c, t, x, h in rows]
    return spark.createDataFrame(full, "ordinal long, source string, source_channel string, title string, summary string, published_us long, discovered_us long, page string")


def test_similarity_needs_tokens_time_and_no_series(spark):
    title, body = "Alpha engine opens shared router cache", "Ten words tell the very same story about caches"
    rows = [(1, "a", "news", title, body, 0), (2, "b", "news", title, body, 48), (3, "c", "news", title, body, 97), (4, "r", "release", title + " 1.2", body, 1), (5, "r", "release", title + " 1.3", body, 1), (6, "d", "news", "Nothing alike whatsoever", "Other text", 1), (7, "e", "news", "Patch for CVE-2025-1", "", 1), (8, "f", "news", "Fix", "about CVE-2025-1 here", 2), (9, "g", "news", None, None, 1)]
    pairs = {(r.a, r.b) for r in linkage.similar_pairs(items(spark, rows)).collect()}
    assert pairs == {(1, 2), (1, 4), (1, 5), (2, 4), (2, 5), (7, 8)}


def test_groups_do_not_depend_on_order(spark):
    rows = [(1, "a", "news", "alpha beta gamma delta epsilon zeta", "", 0), (2, "b", "news", "alpha beta gamma delta epsilon eta", "", 0), (3, "c", "news", "beta gamma delta epsilon eta theta", "", 0)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = {r.ordinal: r.story for r in linkage.story_groups(items(spark, rows)).collect()}
        assert got == {1: 1, 2: 1, 3: 1}


def test_pool_defers_capped_channels(spark):
    rows = [(f"r{i:02}", "research", 90.0 - i) for i in range(6)] + [("n", "news", 10.0)]
    got = [r.event_id for r in ranking.candidate_pool(spark.createDataFrame(rows, "event_id string, channel string, score double"), 5, {"research": 1, "release": 0}).orderBy("place").collect()]
    assert got == ["r00", "r01", "r02", "r03", "n"]


PAGE = """<html><head><title>T</title><meta property="article:published_time" content="2025-09-15T10:00:00+02:00">
<script type="application/ld+json">{"@graph": [{"@type": "NewsArticle", "articleBody": "short", "datePublished": "2020-01-01"}]}</script></head>
<body><nav>menu</nav><article><header>h</header><p>Main &amp; text</p><p>goes on.</p><script>x()</script></article><footer>f</footer></body></html>"""


def test_html():
    assert html.plain_text_of("<p>a &lt; b</p>\n<b>c</b>") == "a < b c" and html.plain_text_of(None) == "" and html.plain_text_of("no <tag") .startswith("no")
    assert html.article_text_of(PAGE) == "Main & text goes on."
    assert html.page_date_of(PAGE).isoformat() == "2025-09-15T08:00:00+00:00"
    assert html.page_date_of("<article>On Sept. 1 nothing. March 5, 2024 was it</article>").date().isoformat() == "2024-03-05"
    assert html.page_date_of("<main><time datetime='2024-02-03T00:00:00Z'></time></main>").date().isoformat() == "2024-02-03" and html.page_date_of("<p>none</p>") is None


def test_dates_and_clocks_apart():
    page = "<div class='post-date'>2026-08-13</div><span class='time'>13:10:50</span><div class='date'>2020-01-01</div>"
    assert html.page_date_of(page).isoformat() == "2026-08-13T13:10:50+00:00" and html.page_date_of(page, "Asia/Shanghai").isoformat() == "2026-08-13T05:10:50+00:00"
    assert html.page_date_of("<article><h1>x</h1><p>Sept. 3 and 2024-05-06 07:08:09, later May 5, 2024</p></article>").isoformat() == "2024-05-05T00:00:00+00:00"
    assert html.date_in_text("2024-13-40 or Foo 3, 2024") is None
    broken = "<div class='entry'><p>kept<div>also</p></span></div></div></p><nav>no</nav>"
    assert html.article_text_of(broken) == "kept also" and html.summary_of(None)["published"] is None
    nested = '<script type="application/ld+json">{"a": [{"@type": ["Thing", "Report"], "datePublished": "2024-01-02"}]}</script><script type="application/ld+json">{bad</script>'
    assert html.page_date_of(nested).date().isoformat() == "2024-01-02"


RSS = "<rss><channel><item><title>One &amp; two</title><link>/p/1</link><description>&lt;p&gt;Body&lt;/p&gt;</description><pubDate>Mon, 15 Sep 2025 07:37:55 +0200</pubDate></item><item><title>No link</title></item></channel></rss>"


def test_readers_and_health(spark):
    payloads = [
        ("a", "rss", "https://a.example/feed", RSS), ("b", "rss", "https://b.example/feed", "not xml"), ("c", "hackernews", "https://c.example/", '[{"id": 7, "type": "story", "title": "S", "score": 120}, {"id": 8, "type": "job", "title": "J"}]'),
        ("d", "github_releases", "https://d.example/", '[{"id": 1, "html_url": "https://d.example/1", "tag_name": "v1", "draft": false}, {"id": 2, "draft": true}]'), ("e", "html_index", "https://e.example/", '<a href="/x">X</a><a href="/x">again</a><a href="mailto:z">m</a>'), ("f", "unknown", "u", "x"), ("g", "rss", None, None),
        ("h", "huggingface_models", "https://h.example/", '[{"id": "n/m", "lastModified": "2025-09-01T00:00:00Z", "tags": ["base_model:quantized:x"]}, {"id": "n/k", "lastModified": "2025-09-01T00:00:00Z", "sha": "s"}]'),
    ]
    read = feeds.read_payloads(spark.createDataFrame(payloads, "source string, kind string, url string, body string"))
    rows = {(r.source, r.place): r for r in read.where("error is null").collect()}
    assert set(rows) == {("a", 1), ("c", 1), ("d", 1), ("e", 1), ("h", 1)}
    assert rows["a", 1].url == "https://a.example/p/1" and rows["a", 1].summary == "Body" and rows["c", 1].metrics["score"] == "120" and rows["h", 1].title == "k"
    sources = spark.createDataFrame([(s,) for s in "abcz"], "source string")
    assert {r.source: r.status for r in feeds.health(read, sources).collect()} == {"a": "ok", "b": "failed", "c": "ok", "z": "disabled"}


def test_streams_equal_batches(spark, data_dir, tmp_path):
    schema = spark.read.parquet(f"{data_dir}/events.parquet").schema
    (tmp_path / "in").mkdir()
    spark.read.parquet(f"{data_dir}/events.parquet").repartition(3).write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 10).parquet(str(tmp_path / "in"))
    query = facades.stream_windows(stream, late="400 days").writeStream.outputMode("complete").format("memory").queryName("windows").start()
    query.processAllAvailable()
    query.stop()
    batch = facades.stream_windows(spark.read.parquet(f"{data_dir}/events.parquet"))
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, batch.collect()))


def test_upsert_keeps_the_best_row(spark, tmp_path):
    for name, rows in (("one", [("d1", 3, "x"), ("d2", 1, "y")]), ("two", [("d1", 2, "z"), ("d2", 2, "w")])):
        spark.createDataFrame(rows, "day string, rank int, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("day string, rank int, text string").parquet(str(tmp_path / "in"))
        facades.upsert_best(stream, str(tmp_path / "out"), "day", "rank").awaitTermination()
    store = facades.BestRows(spark, str(tmp_path / "out"), "day", "rank")
    assert sorted(tuple(r) for r in store.read().collect()) == [("d1", 2, "z"), ("d2", 1, "y")]
    store.merge(spark.createDataFrame([("d1", 1, "replayed")], "day string, rank int, text string"), 1)  # a batch seen before
    store.merge(spark.createDataFrame([("d2", 1, "equal"), ("d3", 4, "new")], "day string, rank int, text string"), 2)
    assert sorted(tuple(r) for r in store.read().collect()) == [("d1", 2, "z"), ("d2", 1, "y"), ("d3", 4, "new")]


def test_streams_of_pairs_ledger_and_audit(spark, tmp_path):
    rows = [("k", "2025-09-15 00:00:00", 60.0), ("k", "2025-09-16 00:00:00", 50.0), ("m", "2025-09-15 01:00:00", 5.0), ("k", "2025-09-20 00:00:00", 1.0)]
    batch = spark.createDataFrame(rows, "key string, t string, amount double").selectExpr("key", "cast(t as timestamp) at", "amount")
    batch.write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    pairs = facades.stream_pairs(stream(), stream(), "key", "at").writeStream.format("memory").queryName("pairs").trigger(availableNow=True).start()
    pairs.awaitTermination()
    assert spark.table("pairs").where("at_a <> at_b").count() == 2 and spark.table("pairs").count() == 6
    ledger = facades.stream_ledger(stream().selectExpr("date_format(at, 'yyyy-MM') day", "amount"), 100.0).writeStream.outputMode("update").format("memory").queryName("ledger").trigger(availableNow=True).start()
    ledger.awaitTermination()
    assert [tuple(r) for r in spark.table("ledger").collect()] == [("2025-09", 4, 116.0, True)]
    facades.admit_or_audit(stream(), str(tmp_path / "out"), facades.F.col("amount") > 10).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/accepted")).count() == 2 and spark.read.parquet(str(tmp_path / "out/audit")).count() == 2


def test_pages_fill_dates_and_index_articles(spark):
    sources = spark.createDataFrame([("a", "https://a.example/feed", "A News", None, None, 1, "news", "global"), ("e", "https://e.example/", "E", None, "/x", None, "news", "china"), ("n", "https://n.example/", "N", None, None, None, "news", "global")], "source string, url string, display_name string, namespace string, link_pattern string, item_limit int, source_channel string, source_region string")
    feed = "<rss><channel><item><title>One</title><link>/p/1</link></item><item><title>Two</title><link>/p/2</link></item></channel></rss>"
    payloads = [("a", "rss", "https://a.example/feed", feed, 200), ("e", "html_index", "https://e.example/", '<a href="/x1">First</a><a href="/y">no</a><a href="/x2">March 5, 2024</a>', 200), ("n", "rss", "https://n.example/", None, 304)]
    read = feeds.read_payloads(spark.createDataFrame(payloads, "source string, kind string, url string, body string, http_status int"), sources)
    assert read.where("source = 'a'").count() == 1 and read.where("source = 'e'").count() == 2
    pages = spark.createDataFrame([("https://a.example/p/1", "<main><time datetime='2024-02-03T00:00:00Z'></time></main>"), ("https://e.example/x1", "<title>T</title><meta property='og:description' content='D &amp; d'><span class='date'>2024-01-02</span><span class='time'>08:00:00</span>")], "url string, body string")
    dated = feeds.fill_dates(read.where("source = 'a'"), pages, sources).first()
    assert dated.published_at == "2024-02-03T00:00:00Z" and dated.error is None
    articles = {r.url: r for r in feeds.index_articles(read.where("source = 'e'"), pages, sources).collect()}
    first, second = articles["https://e.example/x1"], articles["https://e.example/x2"]
    assert (first.title, first.summary, first.published_at) == ("T", "D & d", "2024-01-02T00:00:00Z")
    assert second.error == "PageMissing" and second.published_at == "2024-03-04T16:00:00Z"
    whole = feeds.fill_dates(read.where("source = 'a'"), pages.limit(0), sources).unionByName(read.where("source <> 'a'"))
    assert {r.source: r.status for r in feeds.health(whole, sources).collect()} == {"a": "failed", "e": "failed", "n": "not_modified"}


def test_rare_tokens_and_salted_tokens_give_the_same_candidates(spark, monkeypatch):
    import numpy as np

    from digestflow.operators import setjoin

    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, int(rng.integers(0, 5)) * 10, sorted({"hot", *rng.choice(words, 6)})) for i in range(150)] + [(200 + i, 20, ["hot", "twin", "pair"]) for i in range(40)]
    df = spark.createDataFrame(rows, "ordinal long, at long, tokens array<string>")

    def exact(jaccard, window):
        out = set()
        for i, (a, ta, x) in enumerate(rows):
            for b, tb, y in rows[i + 1 :]:
                common = len(set(x) & set(y))
                if abs(ta - tb) <= window and common >= jaccard * (len(x) + len(y) - common) and common >= 0.55 * min(len(x), len(y)):
                    out.add((a, b))
        return out

    found = {(r.a, r.b) for r in setjoin.self_candidates(df, 0.38, 0.55, 12).collect()}
    assert exact(0.38, 12) <= found < {(a, b) for a, _, _ in rows for b, _, _ in rows if a < b}
    blocks = setjoin.self_candidates(df, 0.38, 0.55, 12)
    assert blocks.count() == len(found)
    both = df.selectExpr("ordinal", "0L as at", "tokens", "cast(ordinal % 2 as string) as `group`")
    crossed = {(r.a, r.b) for r in setjoin.cross_candidates(both.where("ordinal < 100"), both.where("ordinal >= 100"), 0.5, 0.65).collect()}
    need = {(a, b) for a, _, x in rows for b, _, y in rows if a < 100 <= b and a % 2 == b % 2 and (c := len(set(x) & set(y))) >= 0.5 * (len(x) + len(y) - c) and c >= 0.65 * min(len(x), len(y))}
    assert need <= crossed
    assert setjoin.self_candidates(df.limit(0), 0.38, 0.55, 12).count() == 0
