import datetime as dt
from zoneinfo import ZoneInfo

import pytest

from digestflow.operators import timestamps

UTC = dt.UTC


def us(*parts, tz=UTC):
    return round(dt.datetime(*parts, tzinfo=tz).astimezone(UTC).timestamp() * 1_000_000)


def at(zone, *parts):
    return us(*parts, tz=ZoneInfo(zone))


SOURCES = [("ny", "America/New_York", "mdy"), ("bln", "Europe/Berlin", "dmy"), ("sh", "Asia/Shanghai", "dmy"), ("in", "Asia/Kolkata", "dmy"), ("ldn", "Europe/London", "dmy"), ("none", None, None)]
CASES = [
    ("ny", "2025-09-15T02:13:32Z", us(2025, 9, 15, 2, 13, 32)),
    ("ny", "Mon, 15 Sep 2025 04:29:06 -0400", us(2025, 9, 15, 8, 29, 6)),
    ("ny", "09/15/2025 17:30", at("America/New_York", 2025, 9, 15, 17, 30)),
    ("bln", "15/09/2025 17:30", at("Europe/Berlin", 2025, 9, 15, 17, 30)),
    ("bln", "2025-09-15 13:14:55", at("Europe/Berlin", 2025, 9, 15, 13, 14, 55)),
    ("bln", "1. März 2026, 04:37 Uhr", at("Europe/Berlin", 2026, 3, 1, 4, 37)),
    ("bln", "29/03/2026 02:30", us(2026, 3, 29, 1, 30)),  # skipped: the offset before the change
    ("bln", "26/10/2025 02:30", us(2025, 10, 26, 0, 30)),  # twice: the earlier
    ("ny", "2025-11-02 01:30:00", us(2025, 11, 2, 5, 30)),
    ("sh", "2025年9月15日 21:01", at("Asia/Shanghai", 2025, 9, 15, 21, 1)),
    ("sh", "2025-09-17 下午10:55", at("Asia/Shanghai", 2025, 9, 17, 22, 55)),
    ("sh", "2025-09-17 上午12:05", at("Asia/Shanghai", 2025, 9, 17, 0, 5)),
    ("sh", "2025-09-15 13:14:55 CST", us(2025, 9, 15, 5, 14, 55)),
    ("ny", "2025-01-15 13:14:55 CST", us(2025, 1, 15, 19, 14, 55)),
    ("in", "Mon, 15 Sep 2025 10:00:00 IST", us(2025, 9, 15, 4, 30)),
    ("ldn", "Mon, 15 Sep 2025 10:00:00 BST", us(2025, 9, 15, 9)),
    ("ny", "Wed Oct  1 14:42:00 UTC 2025", us(2025, 10, 1, 14, 42)),
    ("ny", "September 15, 2025 12:39 AM", at("America/New_York", 2025, 9, 15, 0, 39)),
    ("ny", "May 1, 2026 12:40 PM", at("America/New_York", 2026, 5, 1, 12, 40)),
    ("in", "16 Sep 2025", at("Asia/Kolkata", 2025, 9, 16)),
    ("ny", "1757955134595", 1757955134595000),
    ("ny", "1758091313", 1758091313000000),
    ("ny", "20250915T112130Z", us(2025, 9, 15, 11, 21, 30)),
    ("in", "2025-09-15 18:46:35,572", at("Asia/Kolkata", 2025, 9, 15, 18, 46, 35, 572000)),
    ("ny", "2025-09-16T14:27:50.010+01:00", us(2025, 9, 16, 13, 27, 50, 10000)),
    ("none", "2025-09-15 13:00:00", us(2025, 9, 15, 13)),
    *[("ny", t, None) for t in (None, "", "n/a", "yesterday", "刚刚", "25:61", "2026-04-31 08:00", "2025-13-05T10:00:00Z", "0000-00-00 00:00:00", "Spring 2026", "3 hours ago", "x" * 100_000)],
]


@pytest.fixture(scope="module")
def normalized(spark):
    sources = spark.createDataFrame(SOURCES, "source string, source_tz string, date_order string")
    rows = [("raw_items", i, s, t, None, "clash") for i, (s, t, _) in enumerate(CASES)] + [("raw_items", 900, None, "2025-09-15 13:00:00", None, "clash")]
    df = spark.createDataFrame(rows, "rec_table string, ordinal long, source string, published_at string, discovered_at timestamp, zone string")
    return {r.ordinal: r.utc_us for r in timestamps.normalize_timestamps(df, sources).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_notations(normalized, i):
    assert normalized.get(i) == CASES[i][2], CASES[i]


def test_no_source_counts_as_utc(normalized):
    assert normalized[900] == us(2025, 9, 15, 13)


def test_zone_is_estimated_from_ingestion_times(spark):
    rows = []
    for i in range(200):
        local = dt.datetime(2025, 9, 1) + dt.timedelta(hours=37 * i)
        seen = local.replace(tzinfo=ZoneInfo("America/New_York")).astimezone(UTC) + dt.timedelta(minutes=5 + i % 50)
        rows.append(("raw_items", i, "mute", local.strftime("%Y-%m-%d %H:%M:%S"), seen))
    df = spark.createDataFrame(rows, "rec_table string, ordinal long, source string, published_at string, discovered_at timestamp")
    sources = spark.createDataFrame([("mute", None, None)], "source string, source_tz string, date_order string")
    parsed = timestamps.parse_instants(df, sources)
    zone = timestamps.estimate_zones(parsed, ("UTC", "America/New_York", "America/Los_Angeles", "Asia/Tokyo")).first()
    assert zone.estimated_tz == "America/New_York" and zone.violations == 0
    # among all histories of the IANA database, the one found places every record as New York does
    got = {r.ordinal: r.utc_us for r in timestamps.normalize_timestamps(df, sources).collect()}
    assert all(got[r[1]] == at("America/New_York", *dt.datetime.fromisoformat(r[3]).timetuple()[:6]) for r in rows)
    assert timestamps.normalize_timestamps(df.limit(0), sources).count() == 0


def test_written_offsets_tell_the_zone(spark):
    """Few records suffice where a source writes its own offset: the hidden declared zone is found again."""
    texts = ["Mon, 15 Sep 2025 10:00:00 +0530", "2025-12-01 08:00:00+05:30", "2025-12-02 09:00:00"]
    df = spark.createDataFrame([("source_refs", i, "in", t, None) for i, t in enumerate(texts)], "rec_table string, ordinal long, source string, published_at string, discovered_at timestamp")
    sources = spark.createDataFrame([("in", "Asia/Kolkata", "dmy"), ("other", "UTC", "dmy")], "source string, source_tz string, date_order string")
    found = timestamps.zone_agreement(timestamps.parse_instants(df, sources), sources).collect()
    assert [(r.source, r.agreement, r.violations) for r in found] == [("in", 1.0, 0)]
    assert timestamps.zone_agreement(timestamps.parse_instants(df.limit(0), sources), sources).count() == 0


def test_histories_are_distinct_and_many():
    zones = timestamps.offset_histories()
    assert len(zones) > 100 and "UTC" in zones and len(set(zones)) == len(zones)
