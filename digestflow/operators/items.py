"""Items of feeds: typed views, admission by relevance and freshness, per-source reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from digestflow.functions import text, timestamps, urls

HOURS, MINUTES = 3_600_000_000, 60_000_000
WINDOW_HOURS, TOLERANCE_MINUTES = 36, 5


def typed_items(raw_items: DataFrame) -> DataFrame:
    """raw_items with `published_us` and `discovered_us` (UTC micros), `page` (canonical URL) and `relevant`."""
    once = lambda c: F.explode(F.array(c))  # noqa: E731  keeps long expressions from being inlined at every use
    parts = raw_items.withColumn("_parts", once(timestamps.timestamp_parts(F.col("published_at"))))
    timed = parts.withColumn("published_us", once(timestamps.feed_micros(F.col("_parts"), F.col("published_at")))).drop("_parts")
    relevant = text.is_relevant(F.col("source_ai_focused"), F.col("source_channel"), F.col("title"), F.col("summary"), F.col("metrics"))
    return timed.withColumn("discovered_us", F.unix_micros("discovered_at")).withColumn("page", urls.canonical_url(F.col("url"))).withColumn("relevant", relevant)


def typed_items_sql() -> str:
    return f"""SELECT r.*, {timestamps.feed_micros_sql("r.published_at")} AS published_us, epoch_us(r.discovered_at) AS discovered_us,
        {urls.canonical_url_sql("r.url")} AS page, {text.is_relevant_sql("r")} AS relevant FROM raw_items r"""


def with_run_time(items: DataFrame) -> DataFrame:
    """Adds `run_us`, the last ingestion, as the time of the run (one row beside the items)."""
    return items.crossJoin(F.broadcast(items.agg(F.max("discovered_us").alias("run_us"))))


def admission(items: DataFrame, per_source: bool = False) -> DataFrame:
    """(ordinal, source, reason) of every item: accepted, corroborated, outside_window, undated or not_related.

    A dated item is accepted within the window, both ends included; an undated community item if it was found within the window and its page
    is that of an accepted item (of its own source where per_source). One aggregation by page with map-side combine decides that.
    """
    late, early = F.col("run_us") + F.lit(TOLERANCE_MINUTES * MINUTES).cast("long"), F.col("run_us") - F.lit(WINDOW_HOURS * HOURS).cast("long")
    dated = F.col("relevant") & F.col("published_us").isNotNull()
    accepted = dated & F.col("published_us").between(early, late)
    waiting = F.col("relevant") & F.col("published_us").isNull() & (F.col("source_channel") == "community") & F.col("discovered_us").between(early, late)
    marked = items.select("ordinal", "source", "page", "relevant", "published_us", "source_channel", accepted.alias("accepted"), waiting.alias("waiting"))
    keys = ["page", "source"] if per_source else ["page"]
    verified = marked.where("accepted").select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct().withColumn("_verified", F.lit(True))
    joined = marked.join(verified, [F.col("waiting"), *[F.col(k) == F.col(f"_{k}") for k in keys]], "left")
    reason = (
        F.when(~F.col("relevant"), "not_related")
        .when(F.col("accepted"), "accepted")
        .when(F.col("waiting") & F.col("_verified"), "corroborated")
        .when(F.col("published_us").isNotNull(), "outside_window")
        .otherwise("undated")
    )
    return joined.select("ordinal", "source", reason.alias("reason"))


def admission_sql(per_source: bool = False) -> str:
    same = "AND v.source = w.source" if per_source else ""
    return f"""WITH t AS ({typed_items_sql()}), run AS (SELECT max(discovered_us) AS run_us FROM t),
      w AS (SELECT t.*, relevant AND published_us IS NOT NULL AND published_us BETWEEN run_us - {WINDOW_HOURS * HOURS} AND run_us + {TOLERANCE_MINUTES * MINUTES} AS accepted,
                   relevant AND published_us IS NULL AND source_channel = 'community' AND discovered_us BETWEEN run_us - {WINDOW_HOURS * HOURS} AND run_us + {TOLERANCE_MINUTES * MINUTES} AS waiting FROM t, run),
      a AS (SELECT ordinal, source, CASE WHEN NOT relevant THEN 'not_related' WHEN accepted THEN 'accepted'
              WHEN waiting AND EXISTS (SELECT 1 FROM w v WHERE v.accepted AND v.page = w.page {same}) THEN 'corroborated'
              WHEN published_us IS NOT NULL THEN 'outside_window' ELSE 'undated' END AS reason FROM w)"""


def probe_report(items: DataFrame, sources: DataFrame) -> DataFrame:
    """For each source: items, relevant, dated, in the window, the three kinds of rejection and the most frequent of them."""
    judged = admission(items, per_source=True).select("ordinal", "reason")
    joined = items.select("ordinal", "source", "relevant", "published_us").join(judged, "ordinal")
    count = lambda c: F.count_if(c)
    counted = joined.groupBy("source").agg(
        F.count("*").alias("fetched"), count(F.col("relevant")).alias("related"), count(F.col("relevant") & F.col("published_us").isNotNull()).alias("dated"),
        count(F.col("reason").isin("accepted", "corroborated")).alias("in_window"), count(F.col("reason") == "not_related").alias("not_related"),
        count(F.col("reason") == "undated").alias("undated"), count(F.col("reason") == "outside_window").alias("outside_window"),
    )
    most = F.greatest("not_related", "undated", "outside_window")
    top = F.when(most == 0, F.lit(None)).when(F.col("not_related") == most, "not_related").when(F.col("undated") == most, "undated").otherwise("outside_window")
    named = sources.select("source", "source_tier", "enabled").join(counted, "source", "left")
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("fetched", "related", "dated", "in_window", "not_related", "undated", "outside_window")]
    return named.select("source", "source_tier", "enabled", *numbers, top.alias("top_rejection"))


def limited(items: DataFrame, sources: DataFrame) -> DataFrame:
    """The first `item_limit` items of each enabled source in order of arrival, with the attributes of the source."""
    dim = sources.where("enabled").select(F.col("source").alias("_s"), "item_limit", "display_name")
    most = dim.agg(F.max("item_limit")).first()[0] or 0  # a constant bound lets the rank stop early within each task
    joined = items.join(dim, F.col("source") == F.col("_s"))
    place = F.row_number().over(W.partitionBy("source").orderBy("ordinal"))
    label = F.when(F.trim("source_label") != "", F.col("source_label")).otherwise(F.col("display_name"))
    return joined.withColumn("place", place).where(F.col("place") <= most).where("place <= item_limit").select("ordinal", "source", "place", label.alias("label"))


def source_coverage(items: DataFrame, sources: DataFrame, tier: str = "A") -> DataFrame:
    """One row: the sources of a tier, those with an item, and their share."""
    seen = items.select(F.col("source").alias("_s")).distinct().withColumn("_seen", F.lit(1))
    joined = sources.where(F.col("source_tier") == tier).join(seen, F.col("source") == F.col("_s"), "left")
    return joined.agg(F.count("*").alias("sources"), F.count("_seen").alias("delivering"), F.round(F.avg(F.coalesce("_seen", F.lit(0))), 6).alias("coverage"))


def own_host(items: DataFrame, sources: DataFrame) -> DataFrame:
    """(ordinal, allowed): whether an item's URL is https and on the host of its source."""
    dim = sources.select(F.col("source").alias("_s"), urls.url_host(F.col("url")).alias("_host"))
    allowed: Column = F.lower(F.trim("url")).startswith("https://") & (urls.url_host(F.col("url")) == F.col("_host"))
    return items.join(dim, F.col("source") == F.col("_s"), "left").select("ordinal", F.coalesce(allowed, F.lit(False)).alias("allowed"))
