"""Linking items of one story: page groups, an exact set-similarity join with a time bound, components and their events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestflow.functions import text
from digestflow.operators import windowjoin
from digestflow.operators.components import connected_components, forest
from digestflow.operators.items import HOURS, typed_items_sql
from digestflow.session import cut

JACCARD, CONTAINMENT = 0.38, 0.55
WINDOW_HOURS = 48
# Ranks by which the first member of a group is chosen.
CHANNEL_RANK = {"official": 0, "news": 1, "community": 2, "release": 3, "research": 4}


def tokenised(items: DataFrame) -> DataFrame:
    """(ordinal, source, source_channel, at, ids, tokens) of typed items."""
    head = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.substring(F.coalesce("summary", F.lit("")), 1, 300))
    ids = text.story_ids(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.substring(F.coalesce("summary", F.lit("")), 1, 1200)))
    return items.select("ordinal", "source", "source_channel", F.coalesce("published_us", "discovered_us").alias("at"), ids.alias("ids"), text.title_tokens(head).alias("tokens"))


def similar_pairs(items: DataFrame, window_hours: int = WINDOW_HOURS) -> DataFrame:
    """(a, b, common, jaccard): items within the window that share an identifier, or enough tokens unless both are releases of one source."""
    rows = tokenised(items).withColumn("release", F.col("source_channel") == "release")
    pairs = windowjoin.self_pairs(rows, JACCARD, CONTAINMENT, window_hours * HOURS)
    return pairs.select("a", "b", "common", F.round(F.try_divide("common", F.col("size_a") + F.col("size_b") - F.col("common")), 6).alias("jaccard"))


def similar_pairs_sql() -> str:
    head = "coalesce(title, '') || ' ' || substr(coalesce(summary, ''), 1, 300)"
    whole = "coalesce(title, '') || ' ' || substr(coalesce(summary, ''), 1, 1200)"
    return f"""WITH t AS ({typed_items_sql()}),
      k AS (SELECT ordinal, source, source_channel, coalesce(published_us, discovered_us) AS at, {text.title_tokens_sql(head)} AS tokens, {text.story_ids_sql(whole)} AS ids FROM t),
      p AS (SELECT x.ordinal AS a, y.ordinal AS b, len(list_intersect(x.tokens, y.tokens)) AS common, len(x.tokens) AS na, len(y.tokens) AS nb, list_has_any(x.ids, y.ids) AS named, x.source = y.source AND x.source_channel = 'release' AS series
            FROM k x JOIN k y ON x.ordinal < y.ordinal AND y.at BETWEEN x.at - {WINDOW_HOURS * HOURS} AND x.at + {WINDOW_HOURS * HOURS}),
      pairs AS (SELECT a, b, common, round(common / (na + nb - common), 6) AS jaccard FROM p
                WHERE named OR NOT series AND least(na, nb) > 0 AND common >= {JACCARD} * (na + nb - common) AND common >= {CONTAINMENT} * least(na, nb))"""


def story_groups(items: DataFrame) -> DataFrame:
    """(ordinal, story): items of one page or linked by similarity, directly or through others; story is the least ordinal of the group."""
    paged = cut(items.select("ordinal", "page"), "pages")
    pages = paged.groupBy("page").agg(F.min("ordinal").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    same_page = paged.join(pages, "page").where("ordinal <> b").select(F.col("ordinal").alias("a"), "b")
    found = connected_components(forest(similar_pairs(items).select("a", "b")).unionByName(same_page))
    return paged.select("ordinal").join(found, F.col("ordinal") == F.col("node"), "left").select("ordinal", F.coalesce("component", "ordinal").alias("story"))


def events(items: DataFrame, groups: DataFrame) -> DataFrame:
    """One row for each story: its primary item, the number of members, and time and kind of the latest dated member.

    The primary has the best tier, then channel rank, then the longest summary, then the least ordinal. One aggregation folds a group and collects
    nothing of it; which items are members is the relation story_groups.
    """
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in CHANNEL_RANK.items() for x in p]), F.col("source_channel")), F.lit(9))
    brief = items.select("ordinal", "source", "source_tier", "source_channel", "source_time_kind", "published_us", "page", "title", F.length(F.coalesce("summary", F.lit(""))).alias("length"))
    joined = brief.join(groups, "ordinal")
    best = F.min(F.struct(F.col("source_tier"), rank.alias("r"), (-F.col("length")).alias("l"), F.col("ordinal"), F.col("page"), F.col("title"), F.col("source_time_kind")))
    latest = F.max(F.when(F.col("published_us").isNotNull(), F.struct(F.col("published_us"), (-F.col("ordinal")).alias("o"), F.col("source_time_kind"))))
    folded = joined.groupBy("story").agg(best.alias("p"), latest.alias("d"), F.count("*").alias("members"), F.count_distinct("source").alias("sources"))
    return folded.select(
        "story", F.substring(F.sha2("p.page", 256), 1, 16).alias("event_id"), F.col("p.ordinal").alias("primary_ordinal"), F.col("p.page").alias("canonical_url"), F.col("p.title").alias("title"),
        F.col("d.published_us").alias("published_us"), F.coalesce("d.source_time_kind", "p.source_time_kind").alias("source_time_kind"), F.col("members"), F.col("sources"),
    )


def story_groups_sql() -> str:
    return (
        similar_pairs_sql().replace("WITH t AS", "WITH RECURSIVE t AS", 1)
        + """,
      e AS (SELECT a, b FROM pairs UNION SELECT x.ordinal, y.ordinal FROM t x JOIN t y ON x.page = y.page AND x.ordinal <> y.ordinal),
      both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
      reach(ordinal, other) AS (SELECT ordinal, ordinal FROM t UNION SELECT r.ordinal, w.b FROM reach r JOIN both_ways w ON r.other = w.a),
      g AS (SELECT ordinal, min(other) AS story FROM reach GROUP BY ordinal)"""
    )
