"""Reserve sizing: control-error shares, percentile grids, limits, bootstrap."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headroom.functions.numbers import percent_of
from headroom.operators.quantiles import interpolated, linear_ranks
from headroom.operators.ranks import Distribution, distribution_of
from headroom.scale import as_columns, join_null_safe

# Control-error levels (name, MW target, allowed % of time).
LEVELS = [("Level 1", 35.0, 30.0), ("Level 2", 65.0, 5.0)]
GRID_STEP = 1000  # grid percentiles are thousandths
CLEAN = 9  # decimals at which thresholds are compared, so that float noise cannot flip a count


def block_total(df: DataFrame, block: str, areas: list[str], value: str = "quantity", region: str = "region", time=("valid_from", "valid_to")) -> DataFrame:
    """Block value per time, or the sum of its areas (nulls as 0) where the block has none."""
    own = F.max(F.when(F.col(region) == block, F.col(value)))
    parts = F.sum(F.when(F.col(region).isin(areas), F.coalesce(F.col(value), F.lit(0.0))))
    return df.groupBy(*as_columns(time)).agg(F.coalesce(own, parts, F.lit(0.0)).alias(value)).withColumn(region, F.lit(block))


def distribution(df: DataFrame, value: str = "quantity", by=None) -> DataFrame:
    """(by…, value, weight): rows per distinct value, nulls as a value of their own.

    All sizing operators take this table (with `weight`) in place of the rows;
    it is made in one pass with map-side combine.
    """
    return df.groupBy(*as_columns(by), F.col(value).cast("double").alias(value)).agg(F.count(F.lit(1)).alias("weight"))


def share_over_target(df: DataFrame, targets: list[tuple[str, float]], value: str = "quantity", by=None, weight: str | None = None) -> DataFrame:
    """Percent of all rows (nulls included) with |value| over each named target."""
    by = as_columns(by)
    rows = F.lit(1) if weight is None else F.col(weight)
    shares = [
        F.lit(100.0) * F.coalesce(F.sum(F.when(F.abs(F.col(value)) > F.lit(float(t)), rows)), F.lit(0)) / F.sum(rows) for _, t in targets
    ]
    wide = df.groupBy(*by).agg(*[s.alias(f"__s{i}") for i, s in enumerate(shares)])
    rows = F.array(*[
        F.struct(F.lit(n).alias("level"), F.lit(float(t)).alias("target"), F.col(f"__s{i}").alias("share"))
        for i, (n, t) in enumerate(targets)
    ])
    return wide.select(*by, F.inline(rows))


def grid_probabilities(allowed: float = 0.0) -> list[float]:
    """Both tails of the grid p = 0, 0.001, … below max(0.49, allowed share)."""
    top = max(490, -(-round(allowed * 10_000) // 1000))
    return sorted({i / (2 * GRID_STEP) for i in range(top)} | {(2 * GRID_STEP - i) / (2 * GRID_STEP) for i in range(top)})


def grid_bounds(percentiles: DataFrame, by=None) -> DataFrame:
    """(by…, probability, value) of both tails -> (by…, tick, lower, upper)."""
    tick = F.round(F.col("probability") * (2 * GRID_STEP)).cast("int")
    return (
        percentiles.withColumn("tick", F.least(tick, F.lit(2 * GRID_STEP) - tick)).groupBy(*as_columns(by), "tick")
        .agg(F.round(F.min("value"), CLEAN).alias("lower"), F.round(F.max("value"), CLEAN).alias("upper"))
    )


def grid_shares(known: Distribution, bounds: DataFrame, targets: list[tuple[str, float]], span: bool = True) -> DataFrame:
    """`bounds` for every named target with the percent of rows around them, in one look-up for all levels."""
    by = known.by
    sides = [
        F.struct(F.lit(n).alias("level"), F.lit(side).alias("side"), F.round(F.col(column) + sign * t, CLEAN).alias("value"))
        for n, t in targets for side, column, sign in (("lo", "lower", -1), ("hi", "upper", 1))
    ]
    if span:
        sides += [F.struct(F.lit(n).alias("level"), F.lit(c).alias("side"), F.col(c).alias("value")) for n, _ in targets for c in ("lower", "upper")]
    at = known.counts_at(bounds.select(*by, "tick", "lower", "upper", F.inline(F.array(*sides))))

    def side(name: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col(column)))

    per_p = at.groupBy(*by, "level", "tick", "lower", "upper").agg(
        side("lo", "n_below").alias("__lo"), side("hi", "n_upto").alias("__hi"),
        side("lower", "n_below").alias("__lower"), side("upper", "n_upto").alias("__upper"),
    )
    sizes = known.sizes()
    sized = join_null_safe(per_p, sizes, by) if by else per_p.withColumn("n", sizes.select("n").scalar())
    percent = F.lit(100.0) / F.col("n")
    spans = [((F.col("__upper") - F.col("__lower")) * percent).alias("span")] if span else []
    return sized.select(
        *by, "level", (F.col("tick") / F.lit(float(GRID_STEP))).alias("percent"), "lower", "upper",
        ((F.col("n") - F.col("__hi") + F.col("__lo")) * percent).alias("off"),
        ((F.col("__hi") - F.col("__lo")) * percent).alias("within"), *spans,
    )


def symmetric_percentile_grid(
    df, target: float, value: str = "quantity", by=None, allowed: float = 0.0, weight: str | None = None, split: bool | None = None
) -> DataFrame:
    """For p = 0 … 0.489: lower = q(p/2), upper = q(1 − p/2) and the percent of rows around them.

    `off`/`within`: percent outside/inside [lower − target, upper + target];
    `span`: percent inside [lower, upper].  Values count at nine decimals, and
    `df` may be their `Distribution`.
    """
    by = as_columns(by)
    known = distribution_of(df, value, by, weight, split, CLEAN)
    found = interpolated(known.values_at(linear_ranks(known.sizes(), grid_probabilities(allowed)).drop("n", "__place")), [*by, "probability"])
    return grid_shares(known, grid_bounds(found, by), [("", target)]).drop("level")


def closest_percentile(grid: DataFrame, allowed, by=None) -> DataFrame:
    """Grid row whose `off` share is nearest the allowed share; ties go to the smallest p."""
    by = as_columns(by)
    rest = [c for c in grid.columns if c not in by]
    share = allowed if isinstance(allowed, Column) else F.lit(float(allowed))
    distance = F.round(F.abs(F.col("off") - share), CLEAN)
    best = grid.groupBy(*by).agg(F.min_by(F.struct(*rest), F.struct(distance, F.col("percent"))).alias("__best"))
    return best.select(*by, *[F.col(f"__best.{c}").alias(c) for c in rest])


def residual_over_target(
    df, reserves: DataFrame, targets: list[tuple[str, float]], value: str = "quantity", by=None, weight: str | None = None,
    split: bool | None = None,
) -> DataFrame:
    """Percent of non-null rows still beyond ±target after reserves (by…, label, down, up) are applied.

    Returns one row per reserve and target with `down_percent`, `up_percent`;
    null unless down ≤ 0 ≤ up.  Looked up like the grid; `df` may be a `Distribution`.
    """
    by = as_columns(by)
    known = distribution_of(df, value, by, weight, split, CLEAN)
    asked = reserves.select(*by, "label", "down", "up", F.inline(F.array(*[
        F.struct(F.lit(n).alias("level"), F.lit(float(abs(t))).alias("target")) for n, t in targets
    ]))).select("*", F.inline(F.array(
        F.struct(F.lit("down").alias("side"), F.round(F.col("down") - F.col("target"), CLEAN).alias("value")),
        F.struct(F.lit("up").alias("side"), F.round(F.col("up") + F.col("target"), CLEAN).alias("value")),
    )))
    at = known.counts_at(asked)
    keys = [*by, "label", "down", "up", "level", "target"]
    per = at.groupBy(*keys).agg(
        F.max(F.when(F.col("side") == "down", F.col("n_below"))).alias("__below"),
        F.max(F.when(F.col("side") == "up", F.col("n_upto"))).alias("__upto"),
    )
    sizes = known.sizes()
    sized = join_null_safe(per, sizes, by) if by else per.withColumn("n", sizes.select("n").scalar())
    usable = (F.col("down") <= 0) & (F.col("up") >= 0)
    return sized.select(
        *keys,
        F.when(usable, F.lit(100.0) * F.col("__below") / F.col("n")).alias("down_percent"),
        F.when(usable, F.lit(100.0) * (F.col("n") - F.col("__upto")) / F.col("n")).alias("up_percent"),
    )


def limits_passed(residuals: DataFrame, allowed: dict[str, float], by=None) -> DataFrame:
    """Per reserve: which control-error levels hold, in words."""
    keys = [*as_columns(by), "label"]
    limits = F.create_map(*[F.lit(x) for n, a in allowed.items() for x in (n, float(a))])
    total = F.round(F.col("down_percent") + F.col("up_percent"), CLEAN)
    passed = F.coalesce(total <= F.element_at(limits, F.col("level")), F.lit(False))
    held = F.array_sort(F.collect_set(F.when(passed, F.col("level"))))  # one entry per level
    size = F.size("held")
    return residuals.groupBy(*keys).agg(held.alias("held"), F.count_distinct("level").alias("levels")).select(
        *keys,
        (size == F.col("levels")).alias("all_passed"),
        F.when(size == 0, "none of the levels").when((size == F.col("levels")) & (size > 1), F.when(size == 2, "both of the levels").otherwise("all of the levels"))
        .otherwise(F.array_join("held", ", ")).alias("verdict"),
    )


def outside_center_lines(df: DataFrame, lines: DataFrame, value: str = "quantity", by=None) -> DataFrame:
    """Percent of rows above the higher and below the lower of two centre lines (by…, low, high).

    Null unless the mean lies strictly between them.
    """
    by = as_columns(by)
    low, high = F.least("low", "high"), F.greatest("low", "high")
    joined = join_null_safe(df, lines.select(*by, low.alias("__low"), high.alias("__high")), by)
    stats = joined.groupBy(*by, "__low", "__high").agg(
        percent_of(F.col(value) > F.col("__high")).alias("__above"), percent_of(F.col(value) < F.col("__low")).alias("__below"),
        F.avg(value).alias("__mean"),
    )
    inside = (F.col("__mean") > F.col("__low")) & (F.col("__mean") < F.col("__high"))
    return stats.select(*by, F.when(inside, F.col("__above")).alias("above"), F.when(inside, F.col("__below")).alias("below"))


def signed_percentiles(df, probs: list[float], value: str = "quantity", by=None, split: bool | None = None) -> DataFrame:
    """Percentiles of v ≥ 0 (p ≥ 0.5) and of v ≤ 0 (p ≤ 0.5) separately, from one distribution.

    The place of 0 splits a group's ranks: those from `n_below` on are not negative, those up to `n_upto` not positive.
    """
    by = as_columns(by)
    known = distribution_of(df, value, by, None, split)
    zero = known.counts_at(known.sizes().withColumn("value", F.lit(0.0)))
    parts = []
    for part, size, first, chosen in (("positive", F.col("n") - F.col("n_below"), F.col("n_below"), [p for p in probs if p >= 0.5]),
                                      ("negative", F.col("n_upto"), F.lit(0), [p for p in probs if p <= 0.5])):
        sized = zero.select(*by, F.lit(part).alias("part"), first.cast("bigint").alias("__first"), size.alias("n")).where("n > 0")
        parts.append(linear_ranks(sized, chosen).withColumn("rank", F.col("rank") + F.col("__first")))
    found = known.values_at(parts[0].unionByName(parts[1]).drop("n", "__place", "__first"))
    return interpolated(found, [*by, "part", "probability"])


def bootstrap_draws(sizes: DataFrame, simulations: int, samples: int, seed: int, by=None) -> DataFrame:
    """(by…, sim, rank): `samples` draws with replacement of a 0-based rank per group and simulation.

    The draw is a hash of seed, group, simulation and draw number, so a lost
    task repeats exactly.
    """
    by = as_columns(by)
    block = 10_000
    per_sim = sizes.withColumn("sim", F.explode(F.sequence(F.lit(0), F.lit(simulations - 1))))
    blocks = per_sim.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit((samples - 1) // block)))).repartition(*by, "sim")
    first = F.col("__block") * block
    draws = blocks.withColumn("__draw", F.explode(F.sequence(first, F.least(first + (block - 1), F.lit(samples - 1)))))
    text = F.concat_ws("-", F.lit(str(seed)), *[F.col(c).cast("string") for c in by], F.col("sim"), F.col("__draw"))
    number = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")
    return draws.select(*by, "sim", (number % F.col("n")).alias("rank"))


def bootstrap_percentiles(
    df, probs: list[float], value: str = "quantity", by=None, simulations: int = 50, samples: int = 300_000,
    seed: int = 1, weight: str | None = None, split: bool | None = None,
) -> DataFrame:
    """Percentiles of resamples with replacement: mean, std and 1.96·std over the simulations.

    A resample is a set of ranks, and values grow with rank; so the order
    statistics are taken on the drawn ranks and only those few ranks are looked
    up in the data.  Nothing the size of simulations × samples is ever joined
    with the sample.  `df` may be a `Distribution`.
    """
    by = as_columns(by)
    known = distribution_of(df, value, by, weight, split)
    sizes = known.sizes()
    # ranks are never null: counted as they are, so that each draw is hashed once
    counted = bootstrap_draws(sizes, simulations, samples, seed, by).groupBy(*by, "sim", "rank").agg(F.count(F.lit(1)).alias("weight"))
    drawn = Distribution(counted.select(*by, "sim", F.col("rank").cast("double").alias("value"), "weight"), [*by, "sim"], split)
    asks = []
    for p in probs:
        place = float(p) * (samples - 1)
        low = int(place)
        asks += [(float(p), low, 1 - (place - low)), (float(p), min(low + 1, samples - 1), place - low)]
    wanted = F.array(*[
        F.struct(F.lit(p).alias("probability"), F.lit(r).cast("bigint").alias("rank"), F.lit(w).alias("share")) for p, r, w in asks
    ])
    per_sim = sizes.drop("n").withColumn("sim", F.explode(F.sequence(F.lit(0), F.lit(simulations - 1))))
    targets = per_sim.select(*by, "sim", F.inline(wanted))
    ranks = drawn.values_at(targets).drop("rank").withColumnRenamed("value", "rank")
    values = known.values_at(ranks.withColumn("rank", F.round("rank").cast("bigint")))
    sims = values.groupBy(*by, "sim", "probability").agg(F.sum(F.col("value") * F.col("share")).alias("value"))
    return sims.groupBy(*by, "probability").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), (F.lit(1.96) * F.stddev_samp("value")).alias("ci95")
    )


def percentile_labels(percents: list[float]) -> dict[float, str]:
    """Settings percent → probability and its label: negative percents mean the lower tail.

    Mixing negative percents with percents below 50 is an error.
    """
    shares = [round(p / 100, 4) for p in percents]
    if any(s < 0 for s in shares) and any(0 < s < 0.5 for s in shares):
        raise ValueError("use either negative percents or percents below 50, not both")
    probs = [round(1 + s, 4) if s < 0 else s for s in shares]
    return {p: f"{round(100 * (1 - p), 4):g}% for -" if p < 0.5 else f"{round(100 * p, 4):g}% for +" for p in probs}


def sizing_report(deterministic: DataFrame, bootstrap: DataFrame, labels: dict[float, str], by=None) -> DataFrame:
    """Method × percentile table: value with ± for the bootstrap, and its text."""
    keys = [*as_columns(by), "probability"]
    names = F.create_map(*[F.lit(x) for p, n in labels.items() for x in (float(p), n)])
    parts = [
        deterministic.select(*keys, F.lit("Deterministic").alias("method"), F.col("value"), F.lit(0.0).alias("deviation")),
        bootstrap.select(*keys, F.lit("Bootstrap").alias("method"), F.col("mean").alias("value"), F.col("std").alias("deviation")),
    ]
    rows = functools.reduce(DataFrame.unionByName, parts)
    text = F.when(F.col("deviation") > 0, F.format_string("%.1f±%.1f", "value", "deviation")).otherwise(F.format_string("%.1f", "value"))
    return rows.withColumns({"percentile": F.element_at(names, F.col("probability")), "text": text})
