"""Timestamps of many notations and zones to one UTC instant, with missing zones estimated by offset histories.

Method: text without a zone is a wall clock. For each source the lags between wall clock and ingestion time, and the offsets that the source itself
writes where it writes any, are counted in small bins. Every offset history of the IANA database (zones with the same history count once) is scored
by its violations: records it would place after their ingestion or implausibly long before it, and written offsets it contradicts.
The history with the fewest violations is chosen, among equals the one that leaves the shortest waits. A declared zone of the source is the
prior and holds where it is a valid zone; the estimate serves sources that declare none, and `zone_agreement` measures it against hidden declared zones.
"""

from __future__ import annotations

import zoneinfo
from datetime import UTC, datetime
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestflow.functions import timestamps as ts

MINUTE = 60_000_000
HOUR, DAY = 60 * MINUTE, 24 * 60 * MINUTE
VALID_ZONE = "^(UTC|[A-Za-z_]+/[A-Za-z_/+-]+[0-9]*)$"


@lru_cache(maxsize=4)
def offset_histories(first_year: int = 2000, last_year: int = 2037) -> tuple[str, ...]:
    """One zone name for each distinct offset history of the IANA database, looked at twice a month."""
    days = [datetime(y, m, d, 12, tzinfo=UTC) for y in range(first_year, last_year + 1) for m in range(1, 13) for d in (1, 15)]
    found: dict[tuple, str] = {}
    for name in sorted(zoneinfo.available_timezones(), key=lambda n: ("/" not in n and n != "UTC", n.startswith("Etc/"), n)):
        if name == "UTC" or ("/" in name and not name.startswith(("posix/", "right/", "SystemV/", "US/"))):
            zone = zoneinfo.ZoneInfo(name)
            found.setdefault(tuple(d.astimezone(zone).utcoffset() for d in days), name)
    return tuple(sorted({"UTC", *found.values()}))


def parse_instants(records: DataFrame, sources: DataFrame) -> DataFrame:
    """records(rec_table, ordinal, source, published_at, discovered_at) to (rec_table, ordinal, source, local_us, fixed_us, shown_min, discovered_us).

    fixed_us is set where the text holds a zone or an epoch, local_us where it is a bare wall clock, shown_min where the zone is an offset in digits; rows
    without an instant are dropped. Null, empty and unreadable texts, relative words, impossible dates and rows without ordinal give no row. Repeated rows each give their row.
    """
    records = records.where("ordinal is not null").select("rec_table", "ordinal", "source", "published_at", "discovered_at")
    dim = sources.where("source is not null").select(F.col("source").alias("_source"), F.col("source_tz").alias("_tz"), F.col("date_order").alias("_order")).dropDuplicates(["_source"])
    once = lambda c: F.explode(F.array(c))  # noqa: E731  a generator keeps the planner from inlining a long expression at each use
    parts = records.join(dim, F.col("source") == F.col("_source"), "left").withColumn("_parts", once(ts.timestamp_parts(F.col("published_at"))))
    parts = parts.withColumn("_wall", once(ts.local_micros(F.col("_parts"), F.col("_order")))).withColumn("_zone", F.coalesce(F.get("_parts", F.lit(8)), F.lit("")))
    minutes = ts.zone_minutes(F.col("_zone"), F.col("_tz"))
    fixed = F.coalesce(ts.epoch_micros(F.col("published_at")), F.when(F.col("_zone") != "", F.col("_wall") - minutes * F.lit(MINUTE).cast("long")))
    local = F.when(F.col("_zone") == "", F.col("_wall"))
    shown = F.when(F.col("_zone").rlike(r"^[+-]\d"), minutes)
    out = parts.select("rec_table", "ordinal", "source", local.alias("local_us"), once(fixed).alias("fixed_us"), shown.alias("shown_min"), F.unix_micros("discovered_at").alias("discovered_us"))
    return out.where(F.coalesce("local_us", "fixed_us").isNotNull())


def _offset(at: Column, zone: Column) -> Column:
    """Minutes east of UTC in a zone at an instant (micros)."""
    return ((F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(at), zone)) - at) / F.lit(MINUTE).cast("long")).cast("int")


def estimate_zones(parsed: DataFrame, candidates: tuple[str, ...] | None = None, bin_minutes: int = 15, late_days: int = 45) -> DataFrame:
    """(source, estimated_tz, violations, records): the offset history of each source with bare wall clocks or written offsets.

    Records are pre-aggregated to (source, hour, lag bin) and (source, hour, written offset) before candidates are scored, so the work grows with sources and
    hours and not with records; lags beyond `late_days` share one bin at either end.
    """
    zones = offset_histories() if candidates is None else candidates
    width = bin_minutes * MINUTE
    hour = lambda c: F.floor(F.col(c) / F.lit(HOUR).cast("long")) * F.lit(HOUR).cast("long")
    far = F.lit(late_days * DAY // width + 4 * 24 * 4).cast("long")
    lag = F.greatest(F.least(F.floor((F.col("discovered_us") - F.col("local_us")) / F.lit(width).cast("long")), far), -far)
    naive = parsed.where(F.col("local_us").isNotNull() & F.col("discovered_us").isNotNull()).select("source", hour("local_us").alias("at"), lag.alias("lag"), F.lit(None).cast("int").alias("shown"))
    written = parsed.where(F.col("fixed_us").isNotNull() & F.col("shown_min").isNotNull()).select("source", hour("fixed_us").alias("at"), F.lit(None).cast("long").alias("lag"), F.col("shown_min").cast("int").alias("shown"))
    bins = naive.unionByName(written).groupBy("source", "at", "lag", "shown").agg(F.count("*").alias("n"))
    scored = bins.withColumn("zone", F.explode(F.array(*[F.lit(z) for z in zones])))
    real = F.col("lag") * F.lit(width).cast("long") + (F.col("at") - ts.wall_to_utc_micros(F.col("at"), F.col("zone")))
    late = F.lit(late_days * DAY).cast("long")
    against = F.when(F.col("shown").isNotNull(), _offset(F.col("at"), F.col("zone")) != F.col("shown")).otherwise((real < F.lit(-width).cast("long")) | (real > late))
    wait = F.when(F.col("lag").isNotNull() & (real > 0), F.least(real, F.lit(6 * HOUR).cast("long")) / F.lit(MINUTE).cast("long") * F.col("n")).otherwise(0.0)
    scored = scored.select("source", "zone", F.when(against, F.col("n")).otherwise(0).alias("bad"), wait.alias("wait"), "n").groupBy("source", "zone").agg(F.sum("bad").alias("violations"), F.sum("wait").alias("wait"), F.sum("n").alias("records"))
    # a few hundred candidates for each source: the best is one aggregate
    best = scored.groupBy("source").agg(F.min(F.struct("violations", "wait", "zone")).alias("b"), F.first("records").alias("records"))
    return best.select("source", F.col("b.zone").alias("estimated_tz"), F.col("b.violations").alias("violations"), "records")


def declared_zones(sources: DataFrame) -> DataFrame:
    """(source, declared_tz): the valid declared zones."""
    return sources.where(F.col("source_tz").rlike(VALID_ZONE)).select("source", F.col("source_tz").alias("declared_tz")).dropDuplicates(["source"])


def zone_agreement(parsed: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, declared_tz, estimated_tz, violations, records, agreement): the estimate made with the declared zones hidden, and the share of wall clocks that both zones place alike."""
    found = declared_zones(sources).join(estimate_zones(parsed), "source").withColumnRenamed("source", "_source")
    clocks = parsed.where(F.col("local_us").isNotNull()).groupBy("source", "local_us").agg(F.count("*").alias("n"))
    same = ts.wall_to_utc_micros(F.col("local_us"), F.col("declared_tz")) == ts.wall_to_utc_micros(F.col("local_us"), F.col("estimated_tz"))
    joined = found.join(clocks, F.col("source") == F.col("_source"), "left")
    return joined.groupBy(F.col("_source").alias("source"), "declared_tz", "estimated_tz", "violations", "records").agg(F.round(F.coalesce(F.sum(F.when(same, F.col("n")).otherwise(0)) / F.sum("n"), F.lit(1.0)), 6).alias("agreement"))


def normalize_timestamps(records: DataFrame, sources: DataFrame, candidates: tuple[str, ...] | None = None) -> DataFrame:
    """(rec_table, ordinal, utc_us): one UTC instant in micros for each record whose text denotes one; sources without any zone count as UTC."""
    parsed = parse_instants(records, sources)
    declared = declared_zones(sources)
    unknown = parsed.join(declared, "source", "left_anti")  # only sources without a declared zone need the estimate
    zones = declared.unionByName(estimate_zones(unknown, candidates).select("source", F.col("estimated_tz").alias("declared_tz"))).select(F.col("source").alias("_source"), F.col("declared_tz").alias("zone"))
    placed = parsed.join(zones, F.col("source").eqNullSafe(F.col("_source")), "left")
    return placed.select("rec_table", "ordinal", F.coalesce("fixed_us", ts.wall_to_utc_micros(F.col("local_us"), F.coalesce("zone", F.lit("UTC")))).alias("utc_us"))


def timestamp_records(raw_items: DataFrame, source_refs: DataFrame) -> DataFrame:
    """The published_at texts of both tables under one schema; references carry no ingestion time."""
    raw = raw_items.select(F.lit("raw_items").alias("rec_table"), "ordinal", "source", "published_at", "discovered_at")
    refs = source_refs.select(F.lit("source_refs").alias("rec_table"), "ordinal", "source", "published_at", F.lit(None).cast("timestamp").alias("discovered_at"))
    return raw.unionByName(refs)
