"""Parsing of timestamps written in many notations into wall-clock parts and a zone text, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English and German month names by their first three letters.
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "mär": 3, "apr": 4, "may": 5, "mai": 5, "jun": 6, "jul": 7,
    "aug": 8, "sep": 9, "oct": 10, "okt": 10, "nov": 11, "dec": 12, "dez": 12,
}

# Zone letters with one meaning, in minutes east of UTC.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120, "EET": 120, "EEST": 180,
    "MSK": 180, "JST": 540, "KST": 540, "HKT": 480, "SGT": 480, "EST": -300, "EDT": -240, "CDT": -300, "MDT": -360, "PST": -480,
    "PDT": -420, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
}

# Zone letters whose meaning depends on where the source is; the pattern is matched against the source's IANA zone.
LOCAL_ZONE_MINUTES = [
    ("CST", "^Asia/|^PRC", 480),
    ("CST", "", -360),
    ("IST", "^Asia/(Kolkata|Calcutta|Colombo)", 330),
    ("IST", "^Europe/", 60),
    ("IST", "^Asia/(Jerusalem|Tel_Aviv)", 120),
    ("IST", "", 330),
    ("BST", "^Asia/", 360),
    ("BST", "", 60),
    ("MST", "^Asia/", 480),
    ("MST", "", -420),
    ("AST", "^Asia/", 180),
    ("AST", "", -240),
]

_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_ZONE = r"(Z|[A-Za-z]{2,5}|(?:UTC|GMT)?[+-]\d{2}:?\d{2})"
_NAME = r"(\p{L}{3,9})\.?"
_HALF = r"([AaPp])\.?[Mm]\.?"

# (pattern, replacement "year|month|day|hour|minute|second|fraction|half|zone|order")
_NOTATIONS = [
    (rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:(?:[Tt]|\s+){_TIME}\s*(?:{_HALF})?\s*{_ZONE}?)?$", "$1|$2|$3|$4|$5|$6|$7|$8|$9|"),
    (r"^(\d{4})(\d{2})(\d{2})(?:[Tt](\d{2})(\d{2})(\d{2})?(?:[.,](\d{1,9}))?\s*" + _ZONE + "?)?$", "$1|$2|$3|$4|$5|$6|$7||$8|"),
    (r"^(\d{4})\s*[-/.年]\s*(\d{1,2})\s*[-/.月]\s*(\d{1,2})\s*日?(?:\s*(上午|下午)?\s*" + _TIME + r")?\s*$", "$1|$2|$3|$5|$6|$7|$8|$4||"),
    (rf"^(?:\p{{L}}{{2,9}}\.?,?\s+)?(\d{{1,2}})\.?[\s-]+{_NAME}[\s-]+(\d{{4}})(?:,?\s+{_TIME}\s*(?:{_HALF})?\s*(?:Uhr)?\s*{_ZONE}?)?$", "$3|$2|$1|$4|$5|$6|$7|$8|$9|"),
    (rf"^(?:\p{{L}}{{2,9}}\.?,?\s+)?{_NAME}\s+(\d{{1,2}}),?\s+(\d{{4}})(?:,?\s+(?:at\s+)?{_TIME}\s*(?:{_HALF})?\s*{_ZONE}?)?$", "$3|$1|$2|$4|$5|$6|$7|$8|$9|"),
    (rf"^\p{{L}}{{3}}\s+{_NAME}\s+(\d{{1,2}})\s+{_TIME}\s*{_ZONE}?\s+(\d{{4}})$", "$8|$1|$2|$3|$4|$5|$6||$7|"),
    (rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:,?\s+{_TIME}\s*(?:{_HALF})?\s*{_ZONE}?)?$", "$3|$1|$2|$4|$5|$6|$7|$8|$9|slash"),
]


def timestamp_parts(text: Column) -> Column:
    """Array of ten strings (year, month, day, hour, minute, second, fraction, half, zone, order); null where no notation fits."""
    text = F.regexp_replace(text, r"^[\s ﻿]+|[\s ]+$", "")
    flat = F.lit(None).cast("string")
    for pattern, layout in reversed(_NOTATIONS):
        flat = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, layout)).otherwise(flat)
    return F.split(flat, r"\|")


def epoch_micros(text: Column) -> Column:
    """Micros of a text of 10 (seconds), 13 (milliseconds) or 16 (microseconds) digits, else null."""
    text = F.trim(text)
    number = F.expr("cast(null as bigint)")
    digits = text.try_cast("bigint")
    for width, factor in ((10, 1_000_000), (13, 1_000), (16, 1)):
        number = F.when(text.rlike(rf"^\d{{{width}}}$"), digits * F.lit(factor).cast("long")).otherwise(number)
    return number


def local_micros(parts: Column, date_order: Column) -> Column:
    """Micros of the wall clock as if it were UTC; null for impossible dates and times. date_order: `mdy` or else `dmy` for dates with slashes."""
    part = lambda i: F.get(parts, F.lit(i))
    number = lambda c: F.when(c == "", F.lit(0)).otherwise(c.try_cast("int"))
    swapped = (part(9) == "slash") & ~(F.coalesce(date_order, F.lit("dmy")) == "mdy")
    month_text, day_text = F.when(swapped, part(2)).otherwise(part(1)), F.when(swapped, part(1)).otherwise(part(2))
    named = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    month = F.when(month_text.rlike(r"^\d+$"), month_text.try_cast("int")).otherwise(F.try_element_at(named, F.lower(F.substring(month_text, 1, 3))))
    hour, half = number(part(3)), F.lower(part(7))
    twelve = half != ""
    after_noon = half.isin("p", "下午")
    hour24 = F.when(~twelve, hour).when((hour > 12) | ((hour == 0) & after_noon), F.lit(None)).otherwise(F.when(after_noon, hour % 12 + 12).when(half == "上午", F.when(hour == 12, 0).otherwise(hour)).otherwise(hour % 12))
    fraction = F.when(part(6) == "", F.lit(0)).otherwise(F.rpad(F.substring(part(6), 1, 6), 6, "0").try_cast("int"))
    stamp = F.try_make_timestamp(part(0).try_cast("int"), month, number(day_text), F.when(hour24 < 24, hour24), F.when(number(part(4)) < 60, number(part(4))), F.when(number(part(5)) < 60, number(part(5))).cast("decimal(16,6)"), F.lit("UTC"))
    return F.unix_micros(stamp) + fraction


def zone_minutes(zone: Column, source_zone: Column) -> Column:
    """Minutes east of UTC that a zone text means at a source; null for no or unknown zone letters."""
    digits = F.regexp_replace(zone, r"[^0-9]", "")
    signed = F.when(zone.contains("-"), -1).otherwise(1)
    minutes = F.when(zone.rlike(r"[+-]\d{2}:?\d{2}$"), signed * (F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")))
    letters = F.upper(zone)
    for name, value in ZONE_MINUTES.items():
        minutes = minutes.when(letters == name, F.lit(value))
    for name, where, value in LOCAL_ZONE_MINUTES:
        minutes = minutes.when((letters == name) & (F.coalesce(source_zone, F.lit("")).rlike(where) if where else F.lit(True)), F.lit(value))
    return minutes


def wall_to_utc_micros(local: Column, zone: Column) -> Column:
    """UTC micros of a wall clock in an IANA zone: the earlier of two instants, and the offset before a skipped hour."""
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), zone))


FEED_RFC = r"^([A-Za-z]{3}, )?[0-9]{1,2} [A-Za-z]{3} [0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2} ([+-][0-9]{4}|GMT|UTC)$"
FEED_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"


def feed_micros(parts: Column, text: Column) -> Column:
    """UTC micros of an RFC 2822 or ISO 8601 text, a bare wall clock being UTC; null for anything else. parts: timestamp_parts(text)."""
    zone = F.coalesce(F.get(parts, F.lit(8)), F.lit(""))
    wall = local_micros(parts, F.lit("dmy"))
    shift = F.when(zone == "", F.lit(0)).otherwise(zone_minutes(zone, F.lit("")))
    return F.when(text.rlike(FEED_RFC) | text.rlike(FEED_ISO), wall - shift * F.lit(60_000_000).cast("long"))


def feed_micros_sql(text: str) -> str:
    """The same in DuckDB SQL."""
    zone = f"regexp_extract({text}, '([+-][0-9]{{2}}):?([0-9]{{2}})$', ['h', 'm'])"
    minutes = f"CASE WHEN regexp_matches({text}, '[0-9]{{2}}:[0-9]{{2}}.*[+-][0-9]{{2}}:?[0-9]{{2}}$') THEN (CASE WHEN {zone}.h[1] = '-' THEN -1 ELSE 1 END) * (substr({zone}.h, 2, 2)::INT * 60 + {zone}.m::INT) ELSE 0 END"
    rfc = f"try_strptime(regexp_replace(regexp_replace({text}, '^[A-Za-z]{{3}}, ', ''), ' ([+-][0-9]{{4}}|GMT|UTC)$', ''), '%d %b %Y %H:%M:%S')"
    iso = f"TRY_CAST(regexp_replace({text}, '(:[0-9.]+)(Z|[+-][0-9]{{2}}:?[0-9]{{2}})$', '\\1') AS TIMESTAMP)"
    return f"(CASE WHEN regexp_matches({text}, '{FEED_RFC}') THEN epoch_us({rfc}) - ({minutes})::BIGINT * 60000000 WHEN regexp_matches({text}, '{FEED_ISO}') THEN epoch_us({iso}) - ({minutes})::BIGINT * 60000000 END)"
