"""Cross-border capacity: net capacity, limiting bids, comparing sources."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headroom.operators.series import fill_ordered, resample_ffill
from headroom.scale import as_columns, join_null_safe


def _dense(df: DataFrame, time: list[str]) -> DataFrame:
    """Every border at every time of its own table, gaps filled forward per border."""
    border = ["out_area", "in_area"]
    times, borders = df.select(*time).distinct(), df.select(*border).distinct()
    # borders are few (area pairs); they ride along as one array per time
    listed = borders.agg(F.collect_set(F.struct(*border)).alias("b")).select("b").scalar()
    grid = times.withColumn("__b", F.explode(listed)).select(*time, "__b.out_area", "__b.in_area")
    return fill_ordered(join_null_safe(grid, df.select(*time, *border, "value"), [*time, *border], "left"), "value", border, time[0])


def net_border_capacity(
    tables: list[DataFrame], by=("out_area", "in_area"), time=("valid_from", "valid_to"), fill: bool = True, step: int | None = None, **_
) -> DataFrame:
    """Day-ahead(a→b) − intraday(a→b) + intraday(b→a) for every day-ahead border.

    A border that day-ahead knows in one direction only is its own opposite: its
    intraday flow is taken off and put back, so the day-ahead value stays.
    Inputs: (time, out_area, in_area, value), one row each.  With `fill` both
    tables are filled forward over their own times first; `step` says that
    those times form a gapless grid.
    """
    day_ahead, intraday = tables
    time = as_columns(time)
    if fill and step:
        day_ahead, intraday = (resample_ffill(t, step, "value", list(by), *time, shared_range=True) for t in (day_ahead, intraday))
    elif fill:
        day_ahead, intraday = _dense(day_ahead, time), _dense(intraday, time)
    keys = [*time, "out_area", "in_area"]
    ahead = day_ahead.select(*keys, F.col("value").alias("__da"), F.lit(None).cast("double").alias("__minus"), F.lit(None).cast("double").alias("__plus"))
    minus = intraday.select(*keys, F.lit(None).cast("double").alias("__da"), F.col("value").alias("__minus"), F.lit(None).cast("double").alias("__plus"))
    plus = intraday.select(
        *time, F.col("in_area").alias("out_area"), F.col("out_area").alias("in_area"),
        F.lit(None).cast("double").alias("__da"), F.lit(None).cast("double").alias("__minus"), F.col("value").alias("__plus"),
    )
    # own and opposite flows meet in one grouping instead of two joins
    merged = ahead.unionByName(minus).unionByName(plus).groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in ("__da", "__minus", "__plus")]
    )
    listed = day_ahead.select("out_area", "in_area").distinct().agg(F.collect_set(F.struct("out_area", "in_area")).alias("b")).select("b").scalar()  # area pairs: few
    opposite = F.struct(F.col("in_area").alias("out_area"), F.col("out_area").alias("in_area"))
    returned = F.when(F.array_contains(listed, opposite), F.col("__plus")).otherwise(F.col("__minus"))
    return merged.select(*keys, (F.col("__da") - F.col("__minus") + returned).alias("value")).where("value is not null")


def limit_bids_by_capacity(
    bids: DataFrame, capacity: DataFrame, bridge: DataFrame, keys=("percentage_level",), value: str = "value"
) -> DataFrame:
    """Bid quantiles cut to the capacity of the borders mapped to their area and direction.

    `keys` are the level, slice and spacing columns both tables share.  Missing
    capacity does not limit.  The least capacity per area, direction and key is
    found first, so bids are joined once by equality.
    """
    keys = as_columns(keys)
    limits = capacity.join(bridge, ["out_area", "in_area"]).groupBy("area", "direction", *keys).agg(F.min(value).alias("__limit"))
    joined = join_null_safe(bids, limits, ["area", "direction", *keys], "left")
    return joined.withColumn(value, F.least(F.col(value), F.col("__limit"))).drop("__limit")


def compare_capacity_sources(sources: dict[str, DataFrame], keys, value: str = "value") -> DataFrame:
    """Every source's value side by side, the row minimum and the source that gave it (first on ties)."""
    keys = as_columns(keys)
    parts = [
        t.select(*keys, F.col(value).cast("double").alias("__value"), F.lit(i).alias("__source"))
        for i, t in enumerate(sources.values())
    ]
    stacked = functools.reduce(DataFrame.unionByName, parts)
    best = F.min_by("__source", F.when(F.col("__value").isNotNull(), F.struct("__value", "__source")))
    names = F.array(*[F.lit(n) for n in sources])
    return stacked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__source") == i, F.col("__value"))).alias(n) for i, n in enumerate(sources)],
        F.min("__value").alias("lowest"), F.try_element_at(names, best + 1).alias("lowest_source"),
    )
