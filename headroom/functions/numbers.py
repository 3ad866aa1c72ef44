"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ratio reported for a non-zero amount over zero ("exceeded").
OVER_ZERO = 2.0


def ceil_dec(value: Column, decimals: int = 0) -> Column:
    """Round up at `decimals` decimals."""
    factor = float(10**decimals)
    return F.ceil(value * factor) / F.lit(factor)


def floor_dec(value: Column, decimals: int = 0) -> Column:
    """Round down at `decimals` decimals."""
    factor = float(10**decimals)
    return F.floor(value * factor) / F.lit(factor)


def safe_ratio(numerator: Column, denominator: Column, over_zero: float = OVER_ZERO) -> Column:
    """Division where 0/0 is 0 and x/0 is `over_zero`."""
    zero = denominator == 0
    return (
        F.when(zero & (numerator == 0), F.lit(0.0))
        .when(zero, F.lit(float(over_zero)))
        .otherwise(numerator / F.when(~zero, denominator))
    )


def version_number(version: Column) -> Column:
    """Version as a whole number (`2`, `2.0`); other text is null."""
    return F.coalesce(version.try_cast("bigint"), version.try_cast("double").try_cast("bigint"))


def clear_nan(value: Column) -> Column:
    """NaN -> null."""
    return F.when(~F.isnan(value), value)


def percent_of(condition: Column, rows: Column | None = None) -> Column:
    """Aggregate: 100 * rows meeting `condition` / rows."""
    return F.lit(100.0) * F.count_if(condition) / (F.count(F.lit(1)) if rows is None else rows)
