"""Realised check and periodic report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from headroom.operators.exceedance import join_realised_proposed, split_by_receiver
from headroom.operators.filters import latest_version
from headroom.operators.results import proposed_vs_realised_report


def realised_check(
    proposed: DataFrame, realised: DataFrame, receivers: DataFrame, keys=("area", "direction"), operator: str = "CASCADE", tie=None, **options
) -> DataFrame:
    """What every receiver has to cut: compare, collect exceedances, newest per product and level, one decimal."""
    from headroom.registry import EXCEEDANCE

    joined = join_realised_proposed(proposed, realised, list(keys), tie=tie)
    exceeded = EXCEEDANCE[operator](joined, by=list(keys), level="level", **options)
    return split_by_receiver(exceeded.withColumnRenamed("sender", "receiver"), receivers, [*keys, "level"], "version_number")


def quarterly_report(
    proposed: DataFrame, realised: DataFrame, capacity: tuple[DataFrame, DataFrame], bridge: DataFrame, keys=("area", "direction"),
    operator: str = "operator",
) -> DataFrame:
    """Realised beside proposed values, both limited by capacity, newest versions only."""
    newest = latest_version(proposed, fixed_cols=[*keys, "level"])
    return proposed_vs_realised_report(newest, realised, list(keys), "level", operator, capacity, bridge)
