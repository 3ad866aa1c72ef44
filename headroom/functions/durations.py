"""ISO-8601 durations as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds per duration unit (a year is 365 days, a month 30 days).
YEAR, MONTH, WEEK, DAY, HOUR, MINUTE = 31_536_000, 2_592_000, 604_800, 86_400, 3_600, 60

_NUMBER = r"(\d+(?:[.,]\d+)?)"
PATTERN = (
    rf"^(-?)P(?=.)(?:{_NUMBER}Y)?(?:{_NUMBER}M)?(?:{_NUMBER}W)?(?:{_NUMBER}D)?"
    rf"(?:T(?=.)(?:{_NUMBER}H)?(?:{_NUMBER}M)?(?:{_NUMBER}S)?)?$"
)
_FACTORS = (YEAR, MONTH, WEEK, DAY, HOUR, MINUTE, 1)
_GROUPS = ";".join(f"0${group}" for group in range(2, 2 + len(_FACTORS)))


def parse_iso_duration(text: Column) -> Column:
    """Signed ISO-8601 duration -> seconds (bigint); other text -> null."""
    trimmed = F.trim(text)
    # all numbers by one match, not by seven; a unit that is not there reads as 0, as a cast of empty text costs an exception
    numbers = F.split(F.translate(F.regexp_replace(trimmed, PATTERN, _GROUPS), ",", "."), ";")
    factors = F.array(*[F.lit(float(f)) for f in _FACTORS])
    weighed = F.zip_with(numbers, factors, lambda n, f: n.try_cast("double") * f)
    total = F.aggregate(weighed, F.lit(0.0), lambda a, x: a + x)
    sign = F.when(trimmed.startswith("-"), -1).otherwise(1)
    return F.when(trimmed.rlike(PATTERN), (total * sign).cast("bigint"))


def format_iso_duration(seconds: Column) -> Column:
    """Seconds -> ISO-8601 text from days down to seconds; zero -> null."""
    size = F.abs(seconds.cast("bigint"))
    days, rest = F.floor(size / DAY), size % DAY

    def part(amount: Column, unit: str) -> Column:
        return F.when(amount > 0, F.concat(amount.cast("bigint").cast("string"), F.lit(unit)))

    clock = F.concat_ws(
        "",
        part(F.floor(rest / HOUR), "H"),
        part(F.floor(rest % HOUR / MINUTE), "M"),
        part(rest % MINUTE, "S"),
    )
    text = F.concat_ws(
        "",
        F.when(seconds < 0, "-").otherwise(""),
        F.lit("P"),
        part(days, "D"),
        F.when(clock != "", F.concat(F.lit("T"), clock)),
    )
    return F.when(size > 0, text)


def duration_seconds(text: str | int) -> int:
    """The same rule for a driver-side parameter; numbers are seconds already."""
    if isinstance(text, int):
        return text
    match = re.match(PATTERN, text.strip())
    if not match:
        raise ValueError(f"not an ISO-8601 duration: {text!r}")
    parts = [float(p.replace(",", ".")) if p else 0.0 for p in match.groups()[1:]]
    total = sum(p * f for p, f in zip(parts, _FACTORS))
    return int(-total if match.group(1) else total)
