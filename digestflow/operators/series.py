"""Event-time aggregates over event streams as batches: windows, sessions, running totals, best rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def windows(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """(start, event_type, n, total): counts and sums over tumbling windows."""
    timed = events.select(F.window(F.col("ts").cast("timestamp"), width).alias("w"), "event_type", "value")
    return timed.groupBy("w", "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.unix_micros("w.start").alias("start_us"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """(user_id, start_us, end_us, n): sessions of each user; the end is the last event plus the gap."""
    timed = events.select("user_id", F.col("ts").cast("timestamp").alias("at"))
    return timed.groupBy(F.session_window("at", gap).alias("s"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.unix_micros("s.start").alias("start_us"), F.unix_micros("s.end").alias("end_us"), "n")


def running_totals(events: DataFrame) -> DataFrame:
    """(day, event_type, n, total, total_so_far): daily sums and their running total by type; only daily sums are ordered."""
    daily = events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(28,6)")).alias("total"))
    so_far = F.sum("total").over(W.partitionBy("event_type").orderBy("day"))
    return daily.select("day", "event_type", "n", F.round(F.col("total").cast("double"), 4).alias("total"), F.round(so_far.cast("double"), 4).alias("total_so_far"))


def best_rows(rows: DataFrame, keys: list[str], rank: Column, *ties: str) -> DataFrame:
    """The row of least rank for each key, ties by the named columns: one aggregation, no sort."""
    order = F.struct(rank.alias("_rank"), *[F.col(t).alias(f"_{t}") for t in ties])
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in keys]), order).alias("_best")).select(*keys, "_best.*")


def metric_totals(items: DataFrame, numeric: Column) -> DataFrame:
    """(source, metric, n, total): sums of the metrics that are plain numbers. numeric: the number in column `v`, else null."""
    exploded = items.where("metrics is not null").select("source", F.explode("metrics").alias("metric", "v")).select("source", "metric", numeric.alias("x"))
    return exploded.groupBy("source", "metric").agg(F.count("x").alias("n"), F.round(F.sum("x"), 4).alias("total"))
