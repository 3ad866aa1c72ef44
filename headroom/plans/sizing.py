"""Yearly sizing: how much reserve covers the control errors, and do the limits hold."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headroom.operators import sizing as z
from headroom.operators.combine import pivot_products
from headroom.operators.filters import slice_time
from headroom.operators.quantiles import interpolated, linear_ranks, quantile_linear
from headroom.operators.ranks import distribution_of
from headroom.operators.series import resample_ffill
from headroom.scale import cut_lineage, drop_scratch

PERCENTS = [-99.5, -90, -80, 80, 90, 99.5]


def control_errors(
    df: DataFrame, value: str = "quantity", region: str = "region", step: str = "PT15M", period: tuple | None = None,
    block: tuple[str, list[str]] | None = None,
) -> DataFrame:
    """Raw control errors -> one filled value per region and grid point.

    Mean per time and region, block total where the block has no value of its
    own, forward fill on the grid of the whole table, cut to the period.
    """
    cells = pivot_products(df, value, region, how="mean").withColumnRenamed("value", value)
    if block:
        name, areas = block
        total = z.block_total(cells, name, areas, value, region)
        cells = cells.where(F.col(region) != name).unionByName(total.select(*cells.columns))
    filled = resample_ffill(cells, step, value, region, shared_range=True)
    return slice_time(filled, period) if period else filled


def sizing_percentiles(df: DataFrame, percents: list[float] | None = None, value: str = "quantity", by: str = "region") -> DataFrame:
    """Interpolated percentiles per region, with the label of each.

    `df` is the filled grid: a region has one row per grid point, a size set by
    the calendar, so the built-in aggregate holds it.
    """
    labels = z.percentile_labels(percents or PERCENTS)
    names = F.create_map(*[F.lit(x) for p, n in labels.items() for x in (float(p), n)])
    found = quantile_linear(df, value, list(labels), by, split=False)
    return found.withColumn("percentile", F.element_at(names, F.col("probability")))


def control_error_limits(
    df: DataFrame, levels: list[tuple[str, float, float]] | None = None, percents: list[float] | None = None, value: str = "quantity",
    by: str = "region", bootstrap: dict | None = None,
) -> DataFrame:
    """Limit analysis: one row per region, level and reserve pair.

    Reserve pairs: the outermost percentiles (`Deterministic`), their bootstrap
    means (`Bootstrap`, if asked for) and, per level, the grid bounds that come
    closest to the allowed share.  Columns: uncorrected share, bounds, residual
    shares, whether the level holds, and the verdict over all levels.

    The rows are read once, into the table of counts; its distribution is built once and answers everything else:
    all percentiles of all levels in one look-up, all their shares in a second, the reserves' in a third.
    """
    levels = levels or z.LEVELS
    targets, allowed = [(n, t) for n, t, _ in levels], {n: p for n, _, p in levels}
    probs = list(z.percentile_labels(percents or PERCENTS))
    low, high = min(probs), max(probs)
    counts = cut_lineage(z.distribution(df, value, by))
    known = distribution_of(counts, value, by, "weight", decimals=z.CLEAN)

    def pair(found: DataFrame, label: str, column: str) -> DataFrame:
        at = {p: F.max(F.when(F.col("probability") == p, F.col(column))) for p in (low, high)}
        return found.groupBy(by).agg(at[low].alias("down"), at[high].alias("up")).select(by, F.lit(label).alias("label"), "down", "up")

    grid = z.grid_probabilities(max(share for _, _, share in levels) / 100)
    ranks = linear_ranks(known.sizes(), sorted({*grid, low, high})).drop("n", "__place")
    found = cut_lineage(interpolated(known.values_at(ranks), [by, "probability"]))
    pairs = [pair(found, "Deterministic", "value")]
    if bootstrap:
        pairs.append(pair(z.bootstrap_percentiles(known, [low, high], value, by, **bootstrap), "Bootstrap", "mean"))
    shares = z.grid_shares(known, z.grid_bounds(found.where(F.col("probability").isin(grid)), by), targets, span=False)
    limits = F.create_map(*[F.lit(x) for n, a in allowed.items() for x in (n, float(a))])
    tops = F.create_map(*[F.lit(x) for n, a in allowed.items() for x in (n, len(z.grid_probabilities(a / 100)) // 2)])
    fits = shares.where(F.round(F.col("percent") * z.GRID_STEP) < F.element_at(tops, F.col("level")))
    best = z.closest_percentile(fits, F.element_at(limits, F.col("level")), [by, "level"])
    pairs.append(best.select(by, F.concat("level", F.lit(" bounds")).alias("label"), F.col("lower").alias("down"), F.col("upper").alias("up")))
    reserves = cut_lineage(functools.reduce(DataFrame.unionByName, pairs))
    residuals = cut_lineage(z.residual_over_target(known, reserves, targets, by=by))
    known.drop()
    verdicts = z.limits_passed(residuals, allowed, by)
    over = z.share_over_target(counts, targets, value, by, "weight").drop("target")
    total = F.col("down_percent") + F.col("up_percent")
    result = cut_lineage(residuals.join(over, [by, "level"]).join(verdicts.drop("all_passed"), [by, "label"]).withColumns(
        {"allowed": F.element_at(limits, F.col("level")), "excess": total, "passed": F.coalesce(F.round(total, z.CLEAN) <= F.element_at(limits, F.col("level")), F.lit(False))}
    ))
    for table in (counts, found, reserves, residuals):
        drop_scratch(table)
    return result
