"""Named operators and handlers; callers may add their own entries."""

from __future__ import annotations

from pyspark.sql import functions as F

AGGREGATES = {
    "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "median": F.median, "count": F.count,
    "first": F.first, "last": F.last, "std": F.stddev_samp, "nunique": F.count_distinct,
}


def aggregate(how):
    """Aggregate function by name; a callable (Column -> Column, e.g. a grouped pandas UDF) is taken as it is."""
    if callable(how):
        return how
    try:
        return AGGREGATES[how]
    except KeyError:
        raise ValueError(f"unknown aggregate {how!r}; known: {sorted(AGGREGATES)}") from None


def _combiners():
    from headroom.operators import capacity, combine

    return {
        "ADD": combine.combine_add,
        "SUBTRACT": combine.combine_subtract,
        "MIN": combine.combine_min,
        "MAX": combine.combine_max,
        "ATC_SUBTRACT": capacity.net_border_capacity,
    }


def _exceedance():
    from headroom.operators import exceedance

    return {"PROPORTION": exceedance.exceeded_proportion, "CASCADE": exceedance.exceeded_cascade}


def __getattr__(name: str):
    """`COMBINE` and `EXCEEDANCE` are filled on first use (their modules import this one)."""
    makers = {"COMBINE": _combiners, "EXCEEDANCE": _exceedance}
    if name not in makers:
        raise AttributeError(name)
    globals()[name] = makers[name]()
    return globals()[name]


# Payload kind -> parser (messages -> points); fill with `register_parser`.
PARSERS: dict = {}


def register_parser(kind: str, parser) -> None:
    """Add or replace the parser of a payload kind (`xml`, `json`)."""
    PARSERS[kind] = parser


def register_combine(name: str, operator) -> None:
    """Add a combine operator: (tables, by=…, time=…, step=…) -> table."""
    __getattr__("COMBINE") if "COMBINE" not in globals() else None
    globals()["COMBINE"][name] = operator


def register_exceedance(name: str, operator) -> None:
    """Add an exceedance operator: (joined, by=…, level=…, …) -> rows."""
    __getattr__("EXCEEDANCE") if "EXCEEDANCE" not in globals() else None
    globals()["EXCEEDANCE"][name] = operator
