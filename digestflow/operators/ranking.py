"""Scoring of events, removal of those told before, the capped candidate pool and ordered digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from digestflow.functions import text, urls
from digestflow.operators import setjoin
from digestflow.operators.items import HOURS
from digestflow.operators.linkage import CHANNEL_RANK
from digestflow.session import cut

# Scores and terms of the ranking.
CHANNEL_SCORE = {"official": 30, "news": 24, "release": 18, "community": 16, "research": 12}
ACTION_TERMS = ("api", "available", "launch", "model", "open source", "pricing", "release", "发布", "上线", "开源", "模型", "降价")
HISTORY_JACCARD, HISTORY_CONTAINMENT = 0.5, 0.65
POOL, POOL_CAPS = 80, {"research": 16, "release": 12}
DIGEST_LIMIT = 12


def _lookup(values: dict[str, int], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for p in values.items() for x in p]), key)


def event_scores(events: DataFrame) -> DataFrame:
    """(event_id, channel, sources, popularity_sum, score) of news events; now is the latest publication among them.

    Everything about one event is folded inside its row, without a shuffle.
    """
    now = events.agg(F.max(F.unix_micros("published_at")).alias("now_us"))
    item = lambda f: F.transform("items", f)
    tiers, channels = item(lambda i: i["source_tier"]), F.array_distinct(item(lambda i: i["source_channel"]))
    ranks = F.transform(channels, lambda c: F.struct(_lookup(CHANNEL_RANK, c).alias("r"), c.alias("c")))
    numbers = F.flatten(item(lambda i: F.filter(F.transform(F.map_values(F.coalesce(i["metrics"], F.create_map().cast("map<string,string>"))), text.numeric), lambda v: v.isNotNull())))
    total = F.aggregate(numbers, F.lit(0.0), lambda s, v: s + v)
    age = (F.col("now_us") - F.coalesce(F.unix_micros("published_at"), F.unix_micros(F.get("items", F.lit(0))["discovered_at"]))) / F.lit(HOURS)
    told = F.lower(F.concat_ws(" ", "title", "summary"))
    action = F.lit(False)
    for term in ACTION_TERMS:
        action = action | told.contains(term)
    base = events.crossJoin(F.broadcast(now)).select(
        "event_id", tiers.alias("tiers"), channels.alias("channels"), F.get(F.array_sort(ranks), F.lit(0))["c"].alias("channel"), F.size(F.array_distinct(item(lambda i: i["source"]))).alias("sources"), F.round(total, 6).alias("popularity_sum"), age.alias("age"), action.alias("action"),
    )
    score = (
        F.when(F.array_contains("tiers", "A"), 12).when(F.array_contains("tiers", "B"), 8).otherwise(4)
        + F.array_max(F.transform("channels", lambda c: _lookup(CHANNEL_SCORE, c)))
        + F.greatest(F.lit(0.0), F.lit(20.0) - F.col("age") / 2)
        + F.least(F.lit(18), (F.col("sources") - 1) * 7)
        + F.when(F.col("action"), 12).otherwise(4)
        + F.least(F.lit(6.0), F.log1p("popularity_sum") / 1.2)
        - F.when(F.col("channels") == F.array(F.lit("research")), 10).otherwise(0)
        - F.when(F.col("channels") == F.array(F.lit("release")), 4).otherwise(0)
    )
    return base.select("event_id", "channel", "sources", "popularity_sum", F.round(F.least(F.lit(100.0), F.greatest(F.lit(0.0), score)), 6).alias("score"))


def event_scores_sql() -> str:
    score = " ".join(f"WHEN '{k}' THEN {v}" for k, v in CHANNEL_SCORE.items())
    rank = " ".join(f"WHEN '{k}' THEN {v}" for k, v in CHANNEL_RANK.items())
    terms = " OR ".join(f"contains(told, '{t}')" for t in ACTION_TERMS)
    return f"""SELECT event_id, channel, sources, round(total, 6) AS popularity_sum, round(least(100.0, greatest(0.0,
        CASE WHEN list_contains(tiers, 'A') THEN 12 WHEN list_contains(tiers, 'B') THEN 8 ELSE 4 END + best
        + greatest(0.0, 20.0 - (now_us - held_us) / {HOURS}.0 / 2) + least(18, (sources - 1) * 7) + CASE WHEN {terms} THEN 12 ELSE 4 END + least(6.0, ln(1 + total) / 1.2)
        - CASE WHEN channels = ['research'] THEN 10 ELSE 0 END - CASE WHEN channels = ['release'] THEN 4 ELSE 0 END)), 6) AS score
      FROM (SELECT event_id, list_transform(items, lambda i: i.source_tier) AS tiers, list_distinct(list_transform(items, lambda i: i.source_channel)) AS channels,
          list_sort(list_transform(items, lambda i: (CASE i.source_channel {rank} END) || i.source_channel))[1][2:] AS channel,
          list_max(list_transform(items, lambda i: CASE i.source_channel {score} END)) AS best, len(list_distinct(list_transform(items, lambda i: i.source)))::INT AS sources,
          coalesce(list_sum(list_transform(flatten(list_transform(items, lambda i: map_values(i.metrics))), lambda v: coalesce({text.numeric_sql("v")}, 0.0))), 0.0) AS total,
          (SELECT max(epoch_us(published_at)) FROM news_events) AS now_us, coalesce(epoch_us(published_at), epoch_us(items[1].discovered_at)) AS held_us,
          lower(title || ' ' || summary) AS told FROM news_events)"""


def told_before(events: DataFrame, history_urls: DataFrame, history_titles: DataFrame) -> DataFrame:
    """(event_id, by_page, by_title): events whose page or title stands in the history.

    Titles match with equal product ids and enough common tokens. Candidates meet under equal product ids and a rare common token.
    """
    past = history_urls.select(urls.canonical_url(F.col("url")).alias("page")).distinct().withColumn("_page", F.lit(True))
    by_page = events.select("event_id", urls.canonical_url(F.col("canonical_url")).alias("page")).join(past, "page").select("event_id").distinct()
    def prepared(df: DataFrame, mark: str) -> DataFrame:
        named = df.select(F.xxhash64(F.lit(mark), F.col("key")).alias("ordinal"), "key", "title")
        return cut(named.select("ordinal", "key", F.lit(0).cast("long").alias("at"), text.title_tokens(F.coalesce("title", F.lit(""))).alias("tokens"), text.product_ids(F.coalesce("title", F.lit(""))).alias("products")), "titles")

    now = prepared(events.select(F.col("event_id").alias("key"), "title"), "e")
    old = prepared(history_titles.where("title is not null").select(F.col("title").alias("key"), "title").distinct(), "h")
    ready = lambda df: df.select("ordinal", "at", "tokens", F.col("products").alias("group"))
    found = setjoin.cross_candidates(ready(now), ready(old), HISTORY_JACCARD, HISTORY_CONTAINMENT)
    side = lambda df, s: df.select(*[F.col(c).alias(f"{c}_{s}") for c in ("ordinal", "key", "tokens", "products")])
    pairs = found.join(side(now, "a"), F.col("a") == F.col("ordinal_a")).join(side(old, "b"), F.col("b") == F.col("ordinal_b"))
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    match = (F.col("products_a") == F.col("products_b")) & (common >= F.lit(HISTORY_CONTAINMENT) * F.least(F.size("tokens_a"), F.size("tokens_b"))) & (common >= F.lit(HISTORY_JACCARD) * (F.size("tokens_a") + F.size("tokens_b") - common)) & (common > 0)
    by_title = pairs.where(match).select(F.col("key_a").alias("event_id")).distinct()
    both = by_page.withColumn("by_page", F.lit(True)).join(by_title.withColumn("by_title", F.lit(True)), "event_id", "full")
    return both.select("event_id", F.coalesce("by_page", F.lit(False)).alias("by_page"), F.coalesce("by_title", F.lit(False)).alias("by_title"))


def recent(history: DataFrame, run: object, days: int = 45) -> DataFrame:
    """The entries of the days before `run`, a pruning of partitions where the table is laid out by target_date."""
    return history.where((F.col("target_date") >= F.date_sub(F.lit(run), days)) & (F.col("target_date") < F.lit(run)))


def told_before_sql() -> str:
    return f"""WITH p AS (SELECT DISTINCT {urls.canonical_url_sql("url")} AS page FROM history_urls),
      e AS (SELECT event_id, {urls.canonical_url_sql("canonical_url")} AS page, {text.title_tokens_sql("coalesce(title, '')")} AS tokens, {text.product_ids_sql("coalesce(title, '')")} AS products FROM news_events),
      h AS (SELECT {text.title_tokens_sql("title")} AS tokens, {text.product_ids_sql("title")} AS products FROM (SELECT DISTINCT title FROM history_titles WHERE title IS NOT NULL)),
      m AS (SELECT e.event_id, len(list_intersect(e.tokens, h.tokens)) AS common, len(e.tokens) AS ne, len(h.tokens) AS nh FROM e JOIN h ON e.products = h.products),
      t AS (SELECT DISTINCT event_id FROM m WHERE common > 0 AND common >= {HISTORY_CONTAINMENT} * least(ne, nh) AND common >= {HISTORY_JACCARD} * (ne + nh - common))
      SELECT event_id, page IN (SELECT page FROM p) AS by_page, event_id IN (SELECT event_id FROM t) AS by_title FROM e WHERE page IN (SELECT page FROM p) OR event_id IN (SELECT event_id FROM t)"""


def candidate_pool(scored: DataFrame, limit: int = POOL, caps: dict[str, int] | None = None) -> DataFrame:
    """(place, event_id, channel, score): the best events with capped channels deferred behind all others.

    Top-k: the places within a capped channel come from a rank that stops at its cap plus the pool's limit.
    """
    caps = POOL_CAPS if caps is None else caps
    order = [F.col("score").desc(), F.col("event_id")]
    nth = F.row_number().over(W.partitionBy("channel").orderBy(*order))
    capped = scored.withColumn("nth", nth).where(F.col("nth") <= limit + max(caps.values(), default=0))
    deferred = F.lit(False)
    for channel, cap in caps.items():
        deferred = deferred | ((F.col("channel") == channel) & (F.col("nth") > cap))
    chosen = capped.withColumn("deferred", deferred).orderBy("deferred", *order).limit(limit)
    return chosen.withColumn("place", F.row_number().over(W.orderBy(F.col("score").desc(), "deferred", "event_id"))).select("place", "event_id", "channel", "score")


def candidate_pool_sql(scored: str = "s", limit: int = POOL) -> str:
    deferred = " OR ".join(f"(channel = '{c}' AND nth > {n})" for c, n in POOL_CAPS.items())
    return f"""n AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY score DESC, event_id) AS nth FROM {scored}),
      d AS (SELECT *, {deferred} AS deferred FROM n ORDER BY deferred, score DESC, event_id LIMIT {limit}),
      pool AS (SELECT row_number() OVER (ORDER BY score DESC, deferred, event_id)::INT AS place, event_id, channel, score FROM d)"""


def batches_of(pool: DataFrame, size: int = 10) -> DataFrame:
    """(place, event_id, batch): the pool in positional batches."""
    return pool.select("place", "event_id", F.floor((F.col("place") - 1) / F.lit(size)).cast("long").alias("batch"))


def ranked_digest(events: DataFrame, pool: DataFrame, limit: int = DIGEST_LIMIT) -> DataFrame:
    """The best publishable events of a pool, then in order of time: first filtered, then limited."""
    joined = pool.join(events.select("event_id", F.unix_micros("published_at").alias("published_us"), "source_time_kind", "title", "summary"), "event_id")
    usable = joined.where("published_us is not null and source_time_kind <> 'community_submitted'")
    best = usable.orderBy("place").limit(limit)
    text_of = F.when(F.trim("summary") != "", F.col("summary")).otherwise(F.col("title"))
    place = F.row_number().over(W.orderBy(F.col("published_us").desc(), "place"))
    return best.select(place.alias("pos"), "event_id", F.substring("title", 1, 100).alias("headline"), F.substring(text_of, 1, 240).alias("brief"), "published_us")
