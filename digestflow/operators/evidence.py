"""Evidence bundles, support of quotes, audits of identifiers and labels of source links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from digestflow.functions import text, urls

EXCERPT = 1_600
MEMBERS = 3
ENOUGH = 800


def evidence(events: DataFrame, excerpt: int = EXCERPT, members: int | None = MEMBERS) -> DataFrame:
    """(evidence_id, event_id, pos, source, url, title, excerpt): the first items of each event; without `members`, all of them."""
    items = F.col("items") if members is None else F.slice("items", 1, members)
    rows = events.select("event_id", F.posexplode(items).alias("p", "i"))
    said = F.when(F.trim(F.coalesce("i.summary", F.lit(""))) != "", F.col("i.summary")).otherwise(F.col("i.title"))
    return rows.select(F.concat_ws("-", "event_id", (F.col("p") + 1).cast("string")).alias("evidence_id"), "event_id", (F.col("p") + 1).alias("pos"), F.col("i.source").alias("source"), F.col("i.url").alias("url"), F.col("i.title").alias("title"), F.substring(said, 1, excerpt).alias("excerpt"))


def quote_support(claims: DataFrame, events: DataFrame, excerpt: int = 6_000) -> DataFrame:
    """(ordinal, verdict): supported, absent, short, or unknown evidence. Each quote is held only against the evidence it cites."""
    cited = evidence(events, excerpt, None).select(F.col("evidence_id").alias("_id"), text.normalize_quote(F.col("excerpt")).alias("_said"), F.lit(True).alias("_known")).dropDuplicates(["_id"])
    quote = text.normalize_quote(F.coalesce("quote", F.lit("")))
    verdict = F.when(F.col("_known").isNull(), "unknown").when(F.length(quote) < text.QUOTE_MINIMUM, "short").when(F.col("_said").contains(quote), "supported").otherwise("absent")
    return claims.join(cited, F.col("evidence_id") == F.col("_id"), "left").select("ordinal", verdict.alias("verdict"))


def claim_coverage(claims: DataFrame, events: DataFrame) -> DataFrame:
    """(event_id, problem, n): claims of unknown events, events without claims, and claims sent more than once."""
    claimed = claims.groupBy("event_id").agg(F.count("*").alias("n"))
    known = events.select(F.col("event_id").alias("_e")).distinct()
    joined = claimed.join(known, F.col("event_id") == F.col("_e"), "full")
    gaps = joined.select(F.coalesce("event_id", "_e").alias("event_id"), F.when(F.col("_e").isNull(), "unexpected").when(F.col("event_id").isNull(), "missing").alias("problem"), F.coalesce("n", F.lit(0)).alias("n")).where("problem is not null")
    twice = claims.groupBy("event_id", "pos", "evidence_id", "quote").agg(F.count("*").alias("k")).where("k > 1").groupBy("event_id").agg(F.sum("k").alias("n"))
    return gaps.unionByName(twice.select("event_id", F.lit("repeated").alias("problem"), "n"))


def corroboration(events: DataFrame) -> DataFrame:
    """(event_id, first_party, top_tier, publishers, corroborated): a first-party item, a top-tier item or two publishers."""
    first = F.exists("items", lambda i: i["source_channel"].isin("official", "release"))
    top = F.exists("items", lambda i: i["source_tier"] == "A")
    domains = F.size(F.array_distinct(F.filter(F.transform("items", lambda i: urls.registrable_domain(i["url"])), lambda d: d.isNotNull())))
    return events.select("event_id", first.alias("first_party"), top.alias("top_tier"), domains.alias("publishers"), (first | top | (domains >= 2)).alias("corroborated"))


def evidence_audit(events: DataFrame) -> DataFrame:
    """(event_id, lengths, total, longest, passed): text lengths of the first items."""
    sizes = F.transform(F.slice("items", 1, MEMBERS), lambda i: F.length(F.coalesce(i["summary"], F.lit(""))))
    longest = F.array_max(sizes)
    return events.select("event_id", F.array_join(F.transform(sizes, lambda n: n.cast("string")), ",").alias("lengths"), F.aggregate(sizes, F.lit(0), lambda s, n: s + n).alias("total"), longest.alias("longest"), (longest >= ENOUGH).alias("passed"))


def link_labels(refs: DataFrame) -> DataFrame:
    """(event_id, target_date, source, title, url, place, label): distinct links in order of first sight; a source with several links is numbered."""
    first = refs.groupBy("target_date", "event_id", "source", "title", "url").agg(F.min("ordinal").alias("first"))
    story = W.partitionBy("target_date", "event_id")
    numbered = first.withColumn("place", F.row_number().over(story.orderBy("first"))).withColumn("i", F.row_number().over(W.partitionBy("target_date", "event_id", "source").orderBy("first"))).withColumn("n", F.count("*").over(W.partitionBy("target_date", "event_id", "source")))
    label = F.when(F.col("n") == 1, F.col("source")).otherwise(F.concat(F.col("source"), F.lit(" "), F.col("i").cast("string"), F.lit("/"), F.col("n").cast("string")))
    return numbered.select("target_date", "event_id", "source", "title", "url", "place", label.alias("label"))


def calendar(refs: DataFrame) -> DataFrame:
    """(target_date, stories, links, published): every day between the first and the last, days without links included."""
    span = refs.agg(F.min("target_date").alias("lo"), F.max("target_date").alias("hi")).where("lo is not null")
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("target_date"))
    sums = refs.groupBy("target_date").agg(F.count_distinct("event_id").alias("stories"), F.count("*").alias("links"))
    return days.join(sums, "target_date", "left").select("target_date", F.coalesce("stories", F.lit(0)).alias("stories"), F.coalesce("links", F.lit(0)).alias("links"), F.col("links").isNotNull().alias("published"))


def richer_copies(items: DataFrame, minimum: int = 500) -> DataFrame:
    """(ordinal, status, size): an item's summary against the longest of its page: complete, enriched, too_short or alone."""
    size = F.length(F.coalesce("summary", F.lit("")))
    best = items.groupBy("page").agg(F.max(size).alias("_best"), F.count("*").alias("_n")).withColumnRenamed("page", "_page")
    joined = items.select("ordinal", "page", size.alias("own")).join(best, F.col("page") == F.col("_page"))
    status = F.when(F.col("own") >= 2_000, "complete").when(F.col("_n") == 1, "alone").when(F.col("_best") < minimum, "too_short").when(F.col("_best") > F.col("own"), "enriched").otherwise("complete")
    return joined.select("ordinal", status.alias("status"), F.when(status == "enriched", F.col("_best")).otherwise(F.col("own")).alias("size"))
