"""Incremental counterparts of batch operators on Structured Streaming."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from digestflow.functions import urls


def stream_pages(items: DataFrame, late: str = "36 hours") -> DataFrame:
    """First sight of each page in a stream of items: repeats within the watermark on discovered_at are dropped, state is bounded by it."""
    keyed = items.withColumn("page", urls.canonical_url(F.col("url"))).withWatermark("discovered_at", late)
    return keyed.dropDuplicatesWithinWatermark(["page"])


def stream_windows(events: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts and sums by event type over tumbling or sliding windows of event time, with late rows up to the watermark."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    window = F.window("at", width, slide) if slide else F.window("at", width)
    return timed.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def stream_sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each user, closed by a gap."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.session_window("at", gap).alias("s"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def stream_pairs(left: DataFrame, right: DataFrame, key: str, time: str, within: str = "48 hours", late: str = "1 hour") -> DataFrame:
    """Rows of two streams with the same key and at most `within` apart in event time; both sides' state is bounded by the interval and the watermarks."""
    a = left.select(*[F.col(c).alias(f"{c}_a") for c in left.columns]).withWatermark(f"{time}_a", late)
    b = right.select(*[F.col(c).alias(f"{c}_b") for c in right.columns]).withWatermark(f"{time}_b", late)
    span = F.expr(f"interval {within}")
    return a.join(b, (F.col(f"{key}_a") == F.col(f"{key}_b")) & (F.col(f"{time}_b") >= F.col(f"{time}_a") - span) & (F.col(f"{time}_b") <= F.col(f"{time}_a") + span))


def admit_or_audit(items: DataFrame, target: str, admitted: Column) -> StreamingQuery:
    """Rows of a stream go to `target/accepted` or, with the reason of refusal, to `target/audit`: late and refused rows are kept and not lost. A replayed batch writes its own folder again."""

    def split(batch: DataFrame, number: int) -> None:
        marked = batch.withColumn("_ok", F.coalesce(admitted, F.lit(False))).persist()
        marked.where("_ok").drop("_ok").write.mode("overwrite").parquet(f"{target}/accepted/batch={number}")
        marked.where("not _ok").drop("_ok").write.mode("overwrite").parquet(f"{target}/audit/batch={number}")
        marked.unpersist()

    return items.writeStream.foreachBatch(split).option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True).start()


def stream_ledger(spends: DataFrame, limit: float) -> DataFrame:
    """(day, rows, total, over): the durable total of each day of spends(day, amount) after every batch, kept as keyed state; over once the limit is passed."""

    def add(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows, total = state.get if state.exists else (0, 0.0)
        for batch in batches:
            rows, total = rows + len(batch), total + float(batch["amount"].sum())
        state.update((rows, total))
        yield pd.DataFrame({"day": [key[0]], "rows": [rows], "total": [round(total, 6)], "over": [total > limit]})

    return spends.groupBy("day").applyInPandasWithState(add, "day string, rows long, total double, over boolean", "rows long, total double", "update", "NoTimeout")


class BestRows:
    """A folder that keeps the row of least rank for each key, in buckets of keys.

    A batch writes new files for the buckets it touches only and then names them in a manifest, which appears in one rename: a crash before leaves the
    manifest before it, and a replayed batch finds its own manifest and does nothing. A stored row gives way only to a strictly better one.
    """

    def __init__(self, spark: SparkSession, target: str, key: str, rank: str, buckets: int = 16) -> None:
        self.spark, self.target, self.key, self.rank, self.buckets = spark, target.rstrip("/"), key, rank, buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.target).getFileSystem(spark._jsc.hadoopConfiguration())

    def _manifest(self) -> tuple[int, dict[str, str]]:
        if not self._files.exists(self._path(self.target)):
            return -1, {}
        names = [s.getPath().getName() for s in self._files.listStatus(self._path(self.target))]
        numbers = [int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json")]
        return (max(numbers), json.loads(self.spark.read.text(f"{self.target}/manifest-{max(numbers)}.json", wholetext=True).first()[0])) if numbers else (-1, {})

    def read(self, buckets: list[str] | None = None) -> DataFrame | None:
        """The rows kept, or None before the first batch."""
        held = self._manifest()[1]
        paths = [p for b, p in held.items() if buckets is None or b in buckets]
        return self.spark.read.parquet(*paths) if paths else None

    def merge(self, batch: DataFrame, number: int) -> None:
        last, held = self._manifest()
        if number <= last:
            return  # a replay
        new = batch.withColumn("_new", F.lit(1))
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        touched = [str(r[0]) for r in batch.select(bucket.alias("b")).distinct().collect()]  # at most `buckets` numbers
        old = self.read(touched)
        both = new if old is None else old.withColumn("_new", F.lit(0)).unionByName(new)
        best = both.groupBy(self.key).agg(F.min_by(F.struct(*batch.columns), F.struct(F.col(self.rank), F.col("_new"))).alias("r")).select("r.*")
        folder = f"{self.target}/data-{number}-{uuid.uuid4().hex[:8]}"
        best.withColumn("_b", bucket).repartition("_b").write.partitionBy("_b").parquet(folder)
        name = f"{self.target}/manifest-{number}.json"
        out = self._files.create(self._path(f"{name}.part"))
        out.write(bytearray(json.dumps({**held, **{b: f"{folder}/_b={b}" for b in touched}}).encode()))
        out.close()
        if not self._files.rename(self._path(f"{name}.part"), self._path(name)):
            raise RuntimeError(f"{name} exists: another writer was first")


def upsert_best(updates: DataFrame, target: str, key: str, rank: str) -> StreamingQuery:
    """Keeps in the folder `target` the row of least rank for each key; BestRows(...).read() gives them."""
    store = BestRows(updates.sparkSession, target, key, rank)
    return updates.writeStream.foreachBatch(store.merge).option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True).start()
