"""Daily procurement: what is available with 95 … 100 % probability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headroom.functions.durations import duration_seconds
from headroom.operators.capacity import limit_bids_by_capacity
from headroom.operators.columns import PRODUCT_MERGE
from headroom.operators.combine import combine_tree
from headroom.operators.filters import data_range, filter_group_extreme, negative_policy, pick_group_argmax, slice_time
from headroom.operators.quantiles import sliced_quantiles
from headroom.operators.series import double_weight
from headroom.sources.points import scan_time_range

# Bids that remain = offered volumes − what is procured already;
# capacity left = day-ahead − intraday (own) + intraday (opposite).
BID_TREE = {"SUBTRACT": [{"ADD": [{"mrid": "sa_mfrr_bid_volumes"}, {"mrid": "da_mfrr_bid_volumes"}, {"mrid": "volumes_afrr"}]}, {"mrid": "procured_reserves"}]}
CAPACITY_TREE = {"ATC_SUBTRACT": [{"business_type": "A31", "contract": "A01"}, {"message_type": "A09", "contract": "A05"}]}
SPACINGS = [(95, 100, 0.1)]


def available_quantiles(
    cells: DataFrame, period: tuple, slices: DataFrame, spacings, by, weight_period: str = "P10D", policy: str = "none",
) -> DataFrame:
    """Combined table (time × product -> value) -> quantiles per slice and spacing.

    The last `weight_period` of the data counts twice.  A product has one cell
    per grid point of the period, so a task per product and slice is enough.
    """
    kept = slice_time(negative_policy(cells, policy, "value", by), period)
    bounds = data_range(kept, *period, "valid_from", "valid_to")
    weighted = double_weight(kept, bounds.select("period_end").scalar(), weight_period, weight="__weight")
    return sliced_quantiles(weighted, "value", slices, spacings, by, weight="__weight", split=False)


def _window(df: DataFrame, period: tuple, lookback: str) -> DataFrame:
    """Rows of the period and of the lookback before it (left-edge values come from there)."""
    from datetime import timedelta

    start, end = period
    return scan_time_range(df, start - timedelta(seconds=duration_seconds(lookback)), end, "valid_from")


def bid_forecast(
    df: DataFrame, period: tuple, slices: DataFrame, tree: dict | None = None, spacings=None, by=("area", "product", "direction"),
    value: str = "quantity", exclusive: str | None = "exclusive_id", tie: str = "id", merge: dict | None = None, lookback: str = "P1D",
    weight_period: str = "P10D", policy: str = "none", steps: dict | None = None,
) -> DataFrame:
    """Bids still available per area, product, direction, slice and probability."""

    def one_per_group(rows: DataFrame, keys: list[str]) -> DataFrame:
        return pick_group_argmax(rows, [exclusive, *keys], value, tie=tie)

    cells = combine_tree(
        _window(df, period, lookback), tree or BID_TREE, list(by), value, replace={"product": merge or PRODUCT_MERGE},
        prepare=one_per_group if exclusive else None, steps=steps,
    )
    return available_quantiles(cells, period, slices, spacings or SPACINGS, list(by), weight_period, policy)


def capacity_forecast(
    df: DataFrame, period: tuple, slices: DataFrame, tree: dict | None = None, spacings=None, value: str = "quantity",
    position: str | None = "position", lookback: str = "P30D", weight_period: str = "P10D", policy: str = "none",
) -> DataFrame:
    """Cross-zonal capacity left per border, slice and probability."""
    border = ["out_area", "in_area"]

    def last_position(rows: DataFrame, keys: list[str]) -> DataFrame:
        return filter_group_extreme(rows, {position: "max"}, [*keys, "valid_from", "valid_to", *border, value])

    cells = combine_tree(
        _window(df, period, lookback), tree or CAPACITY_TREE, border, value, prepare=last_position if position else None
    )
    return available_quantiles(cells, period, slices, spacings or SPACINGS, border, weight_period, policy)


LEVEL_KEYS = ["position", "spacing_start", "spacing_stop", "spacing_step", "percentage_level"]


def limited_bids(bids: DataFrame, capacity: DataFrame, bridge: DataFrame) -> DataFrame:
    """Bid quantiles limited by capacity quantiles of the same slice, spacing and level."""
    return limit_bids_by_capacity(bids, capacity.select("out_area", "in_area", *LEVEL_KEYS, "value"), bridge, LEVEL_KEYS)


def sent_levels(df: DataFrame, start: float = 95, end: float = 100, step: float = 1) -> DataFrame:
    """Only the whole levels that are sent out."""
    from headroom.operators.filters import filter_send_levels

    return filter_send_levels(df, start, end, step).withColumn("value", F.round("value", 1))
