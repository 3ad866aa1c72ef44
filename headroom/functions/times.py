"""Time parsing, zones and formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone letters -> hours added to reach UTC: the alphabet without J counts 1 to 12 up to M and -1 to -12 from N on.
# Exceptions by decision: G and H stand for each other.
_LETTERS = [chr(c) for c in range(ord("A"), ord("Z")) if chr(c) != "J"]
MILITARY_HOURS = {letter: n + 1 if n < 12 else 11 - n for n, letter in enumerate(_LETTERS)} | {"Z": 0, "G": 8, "H": 7}

# Accepted layouts, most specific first.
LAYOUTS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm",
    "yyyyMMdd'T'HHmmss", "yyyyMMdd'T'HHmm", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "d MMM yyyy HH:mm:ss", "d MMM yyyy HH:mm", "d MMM yyyy",
)
# What may stand behind a clock time: hours and minutes from UTC, or a zone's name of up to five letters.
OFFSET_TEXT = r"((?:\+|-)(?:[01]\d|2[0-3]):?[0-5]\d|\p{Alpha}{1,5})$"


def parse_datetime_any(text: Column) -> Column:
    """Text in any of the accepted layouts, with offset, zone letter or none -> UTC timestamp.

    Text without a zone is read as UTC; unknown text gives null.
    """
    trimmed = F.trim(text)
    has_clock = trimmed.rlike(r"\d:?\d{2}(:?\d{2})?(\.\d+)?\s*" + OFFSET_TEXT) & trimmed.rlike(r"[T:]")
    zone = F.when(has_clock, F.regexp_extract(trimmed, r"\s*" + OFFSET_TEXT, 1)).otherwise("")
    local = F.when(has_clock, F.regexp_replace(trimmed, r"\s*" + OFFSET_TEXT, "")).otherwise(trimmed)
    # one element, so that its parts are found once and not again in every place that uses them
    parts = F.array(F.struct(local.alias("local"), zone.alias("zone")))
    any_layout = F.transform(parts, lambda one: _utc(one.getField("local"), one.getField("zone"))).getItem(0)
    # the layout of our own documents by its shape: a layout that fails costs an exception
    usual = F.try_to_timestamp(trimmed, F.lit("yyyy-MM-dd'T'HH:mm'Z'")).cast("timestamp")
    return F.when(trimmed.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\dZ$"), usual).otherwise(any_layout)


def _utc(local: Column, zone: Column) -> Column:
    """UTC time of a clock text and the text of its zone."""
    naive = F.coalesce(*[F.try_to_timestamp(local, F.lit(layout)) for layout in LAYOUTS])
    digits = F.regexp_replace(F.regexp_replace(zone, ":", ""), r"^[+-]", "")
    numeric = zone.rlike(r"^[+-]\d")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    offset = F.when(numeric, F.when(zone.startswith("-"), -minutes).otherwise(minutes) * 60)
    letters = F.create_map(*[F.lit(x) for pair in MILITARY_HOURS.items() for x in pair])
    word = F.upper(zone)
    named = F.when(word.isin("UTC", "GMT"), F.lit(0)).otherwise(-F.element_at(letters, word) * 3600)
    shift = F.when(zone == "", F.lit(0)).otherwise(F.coalesce(offset, named))
    return F.timestamp_micros(F.unix_micros(naive) - shift * F.lit(1_000_000).cast("bigint"))


def to_zone(time: Column, zone: str | Column, naive: bool = True) -> Column:
    """Wall clock in `zone` of a UTC time (time zone rules incl. summer time)."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    local = F.convert_timezone(F.lit("UTC"), zone, time.cast("timestamp_ntz"))
    return local if naive else local.cast("timestamp")


def localize(time: Column, zone: str | Column) -> Column:
    """UTC time of a wall clock given in `zone`."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(zone, F.lit("UTC"), time.cast("timestamp_ntz"))


def format_utc(time: Column, layout: str = "yyyy-MM-dd'T'HH:mm'Z'") -> Column:
    """UTC text of a time."""
    return F.date_format(time.cast("timestamp"), layout)


def strip_zone(time: Column, zone: str = "UTC") -> Column:
    """Convert to `zone`, then drop the zone (for exports)."""
    return to_zone(time, zone).cast("timestamp_ntz")
