"""Column functions."""

from headroom.functions.durations import duration_seconds, format_iso_duration, parse_iso_duration
from headroom.functions.numbers import ceil_dec, clear_nan, floor_dec, percent_of, safe_ratio
from headroom.functions.text import (
    contains_any,
    contiguous_substrings,
    order_label_words,
    ordered_subsequence,
    strip_direction_words,
)
from headroom.functions.times import format_utc, localize, parse_datetime_any, strip_zone, to_zone

__all__ = [
    "ceil_dec", "clear_nan", "contains_any", "contiguous_substrings", "duration_seconds", "floor_dec",
    "format_iso_duration", "format_utc", "localize", "order_label_words", "ordered_subsequence",
    "parse_datetime_any", "parse_iso_duration", "percent_of", "safe_ratio", "strip_direction_words",
    "strip_zone", "to_zone",
]
