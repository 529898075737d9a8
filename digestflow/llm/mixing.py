"""Mixing sources to target weights by weighted fair queueing.

Every copy of a document gets a virtual finish time: the tokens of its source up to and including it, in a shuffled order, divided
by the source's target weight. The mix is the copies in order of finish time up to the total budget. Copy k of a source follows all its
copies k-1, at most `max_repeat` times. Prefix sums run in two steps, so no source meets in one task: the shuffled order is cut into
buckets of equal hash ranges, bucket totals are summed over a small table (mixes x sources x buckets), and only inside a bucket
rows are ordered. The same holds for the final cut over buckets of finish time. The finish time at which the budget is reached follows from the totals of the
sources alone, so copies that start later are never written; the number of buckets grows with the documents.

Documents without tokens (null, empty) are in no mix. Sources missing from documents give nothing, their share is reported as 0.
Null sources and non-positive shares are left out. Ties of the shuffle key are broken by doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from digestflow.session import cut

SEED = 7
BUCKETS, BUCKET_ROWS = 256, 100_000


def closing_times(totals: DataFrame, wanted: DataFrame) -> DataFrame:
    """(mix_name, closes): the finish time at which each mix has its budget, from totals(source, whole) and wanted(mix_name, source, target_share, max_repeat, budget).

    At time f a source has served min(f * share, max_repeat * whole) tokens; the sum is linear between the times at which sources run dry. Null where
    all sources run dry first. A few rows for each mix.
    """
    dry = wanted.join(totals, "source").select("mix_name", "budget", "source", F.col("target_share").alias("share"), (F.col("whole") * F.col("max_repeat")).alias("cap"))
    dry = dry.withColumn("at", F.col("cap") / F.col("share"))
    order = W.partitionBy("mix_name").orderBy("at", "source")
    past = order.rowsBetween(W.unboundedPreceding, -1)
    spent, open_ = F.coalesce(F.sum("cap").over(past), F.lit(0.0)), F.sum("share").over(order.rowsBetween(0, W.unboundedFollowing))
    served = dry.select("mix_name", "budget", "at", spent.alias("spent"), open_.alias("open"))
    # the sum is concave, so it lies on or below each of its pieces prolonged, and the last of their crossings with the budget is its own
    crossing = F.max((F.col("budget") - F.col("spent")) / F.col("open"))
    return served.groupBy("mix_name").agg(F.when(F.max(F.col("spent") + F.col("at") * F.col("open")) >= F.max("budget"), crossing).alias("closes"))


def finish_times(sized: DataFrame, targets: DataFrame, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """sized(doc_id, source, tokens), targets(mix_name, source, target_share, max_repeat, total_ratio) to (mix_name, source, doc_id, copy, tokens, finish, budget)."""
    key = F.xxhash64(F.lit(seed), F.col("doc_id"))
    docs = sized.where("tokens > 0 and source is not null").select("doc_id", "source", "tokens", key.alias("_key"), F.pmod(F.shiftright(key, 40), F.lit(buckets)).cast("int").alias("_b"))
    totals = docs.groupBy("source", "_b").agg(F.sum("tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("source").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("n").over(W.partitionBy("source"))
    starts = totals.select(F.col("source").alias("_s"), F.col("_b").alias("_sb"), before.alias("_before"), whole.alias("_whole"))
    within = F.sum("tokens").over(W.partitionBy("source", "_b").orderBy("_key", "doc_id").rowsBetween(W.unboundedPreceding, 0))
    placed = docs.withColumn("_within", within).join(starts, (F.col("source") == F.col("_s")) & (F.col("_b") == F.col("_sb")))
    everything = sized.agg(F.sum("tokens").alias("_all"))
    wanted = targets.where("target_share > 0 and max_repeat > 0 and source is not null").crossJoin(everything).select("mix_name", F.col("source").alias("_ts"), "target_share", "max_repeat", (F.col("total_ratio") * F.col("_all")).alias("budget"))  # one row beside the targets
    closes = closing_times(totals.groupBy("source").agg(F.sum("n").alias("whole")), wanted.withColumnRenamed("_ts", "source"))
    wanted = wanted.join(closes.withColumnRenamed("mix_name", "_cm"), F.col("mix_name") == F.col("_cm"), "left").drop("_cm")
    mixed = placed.join(F.broadcast(wanted), F.col("source") == F.col("_ts")).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("max_repeat").cast("int"))))
    finish = ((F.col("copy") - 1) * F.col("_whole") + F.col("_before") + F.col("_within")) / F.col("target_share")
    queued = mixed.withColumn("finish", finish).where(F.col("closes").isNull() | (F.col("finish") - F.col("tokens") / F.col("target_share") <= F.col("closes") * 1.000001))
    return queued.select("mix_name", "source", "doc_id", "copy", "tokens", "finish", "budget")


def mix(sized: DataFrame, targets: DataFrame, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """(mix_name, source, doc_id, repeats, tokens): how often each document stands in each mix; tokens of one copy."""
    buckets = max(buckets, sized.count() // BUCKET_ROWS)
    queue = cut(finish_times(sized, targets, seed, buckets), "queue")
    span = queue.groupBy("mix_name").agg(F.max("finish").alias("_span")).withColumnRenamed("mix_name", "_m")
    queue = queue.join(F.broadcast(span), F.col("mix_name") == F.col("_m")).drop("_m")  # one row for each mix
    slot = F.least(F.floor(F.col("finish") / F.col("_span") * F.lit(buckets * 16)), F.lit(buckets * 16 - 1)).cast("int")
    queue = queue.withColumn("_slot", slot)
    sums = queue.groupBy("mix_name", "_slot").agg(F.sum("tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("mix_name").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(F.col("mix_name").alias("_m"), F.col("_slot").alias("_ms"), before.alias("_before"), (before + F.col("n")).alias("_after"))
    near = queue.join(starts, (F.col("mix_name") == F.col("_m")) & (F.col("_slot") == F.col("_ms"))).where("_before < budget")
    inside = near.where("_after <= budget").select("mix_name", "source", "doc_id", "tokens")
    edge = near.where("_after > budget")  # one slot of each mix
    running = F.col("_before") + F.sum("tokens").over(W.partitionBy("mix_name", "_slot").orderBy("finish", "source", "doc_id", "copy").rowsBetween(W.unboundedPreceding, 0))
    last = edge.withColumn("_run", running).where("_run <= budget").select("mix_name", "source", "doc_id", "tokens")
    return inside.unionByName(last).groupBy("mix_name", "source", "doc_id").agg(F.count("*").cast("int").alias("repeats"), F.max("tokens").alias("tokens"))


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_name, source, target_share, actual_share, tokens, documents, largest_repeat) for every target; shares are rounded to 6 places."""
    sums = mixed.groupBy("mix_name", "source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("documents"), F.max("repeats").alias("largest_repeat"))
    whole = sums.groupBy("mix_name").agg(F.sum("tokens").alias("_all"))
    joined = targets.select("mix_name", "source", "target_share").join(sums, ["mix_name", "source"], "left").join(whole, "mix_name", "left")
    return joined.select(
        "mix_name", "source", "target_share", F.round(F.coalesce(F.col("tokens") / F.col("_all"), F.lit(0.0)), 6).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("largest_repeat", F.lit(0)).alias("largest_repeat"),
    )
