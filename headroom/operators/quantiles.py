"""Quantiles: order-statistic ("lower") and interpolated ("linear")."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.functions.numbers import clear_nan
from headroom.operators.ranks import distribution_of
from headroom.scale import as_columns, literal_table

PROBABILITY_STEPS = 10_000  # probabilities are integer ten-thousandths (4 decimals)


def spacing_ticks(start: float, stop: float, step: float) -> list[int]:
    """Probabilities of one spacing in ten-thousandths: 1 − stop first, then multiples of the step."""
    first, last = round((100 - stop) * 100), round((100 - start) * 100)
    return [first, *[t for t in range(0, last + 1, round(step * 100)) if t > first]]


def quantile_spacing(spark: SparkSession, spacings: list[tuple[float, float, float]]) -> DataFrame:
    """(start, stop, step) in percent -> one row per probability.

    Columns: spacing_start, spacing_stop, spacing_step, tick (probability in
    ten-thousandths, exact integer), probability, percentage_level.  The
    highest percentage comes first and has the lowest probability.
    """
    rows = [(float(a), float(b), float(c), spacing_ticks(a, b, c)) for a, b, c in spacings]
    table = literal_table(
        spark, rows, "spacing_start double, spacing_stop double, spacing_step double, ticks array<int>"
    )
    return table.select("spacing_start", "spacing_stop", "spacing_step", F.explode("ticks").alias("tick")).withColumns(
        {
            "probability": F.col("tick") / F.lit(float(PROBABILITY_STEPS)),
            "percentage_level": F.round(F.lit(100.0) - F.col("tick") / F.lit(100.0), 2),
        }
    )


def number_array(values, kind: str = "double") -> Column:
    """Array literal of numbers from one SQL text (a column per number is slow for long lists)."""
    return F.expr("array(" + ",".join(f"{float(x)!r}D" if kind == "double" else str(int(x)) for x in values) + ")")


def _ask_ranks(sizes: DataFrame, ticks: list[int]) -> DataFrame:
    """One row per group and requested tick: size of groups times the fixed list."""
    return sizes.withColumn("tick", F.explode(number_array(ticks, "int")))


def quantile_lower(
    df: DataFrame, value: str, ticks: list[int], by=None, weight: str | None = None, floor_zero: bool = True,
    split: bool | None = None,
) -> DataFrame:
    """Order statistic at index tick*(n-1) div 10000 per group; nulls are left out first.

    `ticks` are probabilities in ten-thousandths.  Negative results become 0
    unless `floor_zero` is off.  `weight` counts a row more than once.  `df` may
    be a `Distribution`.  Returns (by…, tick, percentage_level, value).
    """
    by = as_columns(by)
    known = distribution_of(df, value, by, weight, split)
    targets = _ask_ranks(known.sizes(), ticks).withColumn(
        "rank", F.expr(f"(cast(tick as bigint) * (n - 1)) div {PROBABILITY_STEPS}")
    )
    found = known.values_at(targets.drop("n"))
    result = F.greatest(F.col("value"), F.lit(0.0)) if floor_zero else F.col("value")
    return found.select(
        *by, "tick", F.round(F.lit(100.0) - F.col("tick") / F.lit(100.0), 2).alias("percentage_level"),
        result.alias("value"),
    )


def quantile_linear(
    df: DataFrame, value: str, probs: list[float], by=None, weight: str | None = None, split: bool | None = None
) -> DataFrame:
    """Linearly interpolated percentiles per group -> (by…, probability, value).

    `split=False` says that every group is known to be small.  `df` may be a `Distribution`.
    """
    by = as_columns(by)
    if split is False and weight is None:
        # small groups: one built-in exact aggregate, no sorting at all
        wanted = number_array(probs)
        clean = clear_nan(F.col(value).cast("double"))
        found = df.groupBy(*by).agg(F.percentile(clean, wanted).alias("__values"))
        rows = found.select(*by, F.posexplode("__values").alias("__i", "value"))
        return rows.select(*by, F.element_at(wanted, F.col("__i") + 1).alias("probability"), "value")
    known = distribution_of(df, value, by, weight, split)
    found = known.values_at(linear_ranks(known.sizes(), probs).drop("n", "__place"))
    return interpolated(found, [*by, "probability"])


def linear_ranks(sizes: DataFrame, probs: list[float]) -> DataFrame:
    """The two ranks around each probability of each group, with their shares."""
    return (
        sizes.withColumn("probability", F.explode(number_array(probs)))
        .withColumn("__place", F.col("probability") * (F.col("n") - 1))
        .withColumn("__share", F.col("__place") - F.floor("__place"))
        .withColumn("__side", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("rank", F.least(F.floor("__place") + F.col("__side"), F.col("n") - 1))
    )


def interpolated(found: DataFrame, keys: list[str]) -> DataFrame:
    """Values at the ranks of `linear_ranks` put together."""
    part = F.col("value") * F.when(F.col("__side") == 0, 1 - F.col("__share")).otherwise(F.col("__share"))
    return found.groupBy(*keys).agg(F.sum(part).alias("value"))


def sliced_quantiles(
    df: DataFrame, value: str, slices: DataFrame, spacings: list[tuple[float, float, float]], by=None, time: str = "valid_from",
    weight: str | None = None, split: bool | None = None,
) -> DataFrame:
    """Lower quantiles for every time slice, spacing and product.

    Returns (slice fields…, spacing fields…, by…, percentage_level, value).
    """
    from headroom.operators.filters import slice_time_of_day

    by = as_columns(by)
    table = quantile_spacing(df.sparkSession, spacings)
    ticks = sorted({tick for spacing in spacings for tick in spacing_ticks(*spacing)})
    tagged = slice_time_of_day(df, slices, time)
    keys = ["position", *by]
    levels = quantile_lower(tagged, value, ticks, keys, weight, split=split)
    return (
        levels.join(table.drop("percentage_level", "probability"), "tick")
        .join(slices, "position")
        .drop("tick")
    )


def sort_levels(df: DataFrame, keys=None, level: str = "percentage_level") -> DataFrame:
    """Quantile table by level, highest first."""
    return df.orderBy(*[F.col(k) for k in as_columns(keys)], F.col(level).desc())
