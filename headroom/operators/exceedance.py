"""Realised against proposed volumes: joins, proportion, cascade, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headroom.functions.numbers import safe_ratio, version_number
from headroom.operators.filters import dedupe_last, latest_version
from headroom.scale import as_columns, join_null_safe


def unified_level(df: DataFrame, column: str, strategy: str = "max", by=None) -> DataFrame:
    """Smallest, median or largest value of a column (per group)."""
    how = {"min": F.min, "median": F.median, "max": F.max}[strategy]
    return df.groupBy(*as_columns(by)).agg(how(column).alias(column))


def join_realised_proposed(
    proposed: DataFrame, realised: DataFrame, keys, level: str = "level", sender: str = "sender", received: str = "received",
    version: str = "version_number", tie=None,
) -> DataFrame:
    """Latest proposed values beside the newest realised value of every sender, level by level.

    Returns (keys…, level, version, sender, proposed, realised).
    """
    keys = as_columns(keys)
    latest = latest_version(proposed, fixed_cols=[*keys, level], key=version)
    newest = dedupe_last(realised, [*keys, level, sender], [received, *as_columns(tie)])
    left = latest.select(*keys, level, version, F.col("value").alias("proposed"))
    right = newest.select(*keys, level, sender, F.col("value").alias("realised"))
    return join_null_safe(left, right, [*keys, level])


def _reported(exceeded: Column, report_diff: bool, sign: int) -> Column:
    return (F.col("realised") - exceeded) * F.lit(sign) if report_diff else exceeded


def exceeded_proportion(
    joined: DataFrame, by=("area", "direction"), level: str = "level", version: str = "version_number", correct_initial: bool = False,
    report_diff: bool = False, sign: int = -1, strategy: str = "max",
) -> DataFrame:
    """Scale realised/proposed ratios to a sum of 1 for products whose ratios sum to more.

    The allowed value is the ratio times the row's own proposed value
    (`correct_initial`) or times the value at the common level (`strategy`).
    If that level carries several proposed values, only its rows of the newest
    version are used.  Totals are per-product aggregates joined back, so a
    product with most of the rows is not gathered.
    """
    by = as_columns(by)
    rows = joined.withColumns(
        {"__norm": safe_ratio(F.col("realised"), F.col("proposed")), "__v": F.coalesce(version_number(F.col(version)), F.lit(-1))}
    )
    per_version = rows.groupBy(*by, level, "__v").agg(
        F.sum("__norm").alias("__s"), F.min("proposed").alias("__lo"), F.max("proposed").alias("__hi")
    )
    per_level = per_version.groupBy(*by, level).agg(
        F.max("__v").alias("__vmax"), F.max_by("__s", "__v").alias("__s_new"), F.max_by("__lo", "__v").alias("__p_new"),
        F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"),
    )
    common = unified_level(rows, level, strategy, by).withColumnRenamed(level, "__level")
    total = per_version.groupBy(*by).agg(F.sum("__s").alias("__total"))
    at = join_null_safe(join_null_safe(per_level, common, by), total, by).where(F.col(level) == F.col("__level"))
    at = at.withColumn("__single", F.col("__lo") == F.col("__hi")).select(
        *by, "__level", "__vmax", "__single", F.when(F.col("__single"), F.col("__lo")).otherwise(F.col("__p_new")).alias("__value"),
        F.when(F.col("__single"), F.col("__total")).otherwise(F.col("__s_new")).alias("__sum"),
    )
    used = join_null_safe(rows, at.where("__sum > 1"), by).where(
        F.col("__single") | ((F.col(level) == F.col("__level")) & (F.col("__v") == F.col("__vmax")))
    )
    share = F.col("__norm") / F.col("__sum")
    exceeded = share * (F.col("proposed") if correct_initial else F.col("__value"))
    result = used.withColumns({"exceeded": exceeded, "norm": share}).withColumn("value", _reported(F.col("exceeded"), report_diff, sign))
    if not correct_initial:
        result = result.withColumn(level, F.col("__level").cast(joined.schema[level].dataType))
    return result.select(*joined.columns, "norm", "exceeded", "value")


def exceeded_cascade(
    joined: DataFrame, by=("area", "direction"), level: str = "level", report_diff: bool = False, sign: int = -1, **_
) -> DataFrame:
    """Allow volume from the highest level down, never more than proposed in total; share it pro rata.

    At each level: allowed = max(min(proposed − allowed above, Σ realised), 0).
    Products are touched only if over the rows whose level sum exceeds the
    proposed value Σ realised > Σ proposed; only rows that change come back.
    The fold runs over one entry per level (at most the levels of a spacing).
    """
    by = as_columns(by)
    per_level = joined.groupBy(*by, level).agg(F.sum("realised").alias("__used"), F.min("proposed").alias("__proposed"))
    step = F.struct((-F.col(level)).cast("double").alias("order"), F.col(level).alias("level"), F.col("__proposed").alias("proposed"), F.col("__used").alias("used"))
    ordered = per_level.groupBy(*by).agg(F.array_sort(F.collect_list(step)).alias("__levels"))

    def allow(state: Column, item: Column) -> Column:
        final = F.greatest(F.least(item["proposed"] - state["running"], item["used"]), F.lit(0.0))
        entry = F.struct(item["level"].alias("level"), final.alias("allowed"), item["used"].alias("used"))
        return F.struct((state["running"] + final).alias("running"), F.concat(state["out"], F.array(entry)).alias("out"))

    kind = joined.schema[level].dataType.simpleString()
    start = F.expr(f"named_struct('running', cast(0 as double), 'out', cast(array() as array<struct<level:{kind},allowed:double,used:double>>))")
    allowed = ordered.select(
        *by, F.inline(F.aggregate("__levels", start, allow, lambda s: s["out"]))
    ).withColumnsRenamed({"level": level, "allowed": "__allowed", "used": "__used"})
    rows = join_null_safe(joined, allowed, [*by, level])
    over = F.col("__used") - F.col("proposed") > 0
    trigger = rows.groupBy(*by).agg(
        F.sum(F.when(over, F.col("realised"))).alias("__r"), F.sum(F.when(over, F.col("proposed"))).alias("__p")
    ).where("__r > __p").select(*by)
    hit = join_null_safe(rows, trigger, by, "left_semi")
    exceeded = safe_ratio(F.col("realised"), F.col("__used")) * F.col("__allowed")
    result = hit.withColumn("exceeded", exceeded).withColumn("value", _reported(F.col("exceeded"), report_diff, sign))
    return result.where(F.abs(F.col("value") - F.col("realised")) > 0).select(*joined.columns, "exceeded", "value")


def next_version(df: DataFrame, keys, stored: DataFrame, version: str = "version_number") -> DataFrame:
    """Version for each row: 1 + the highest stored version of its key (at least 2), 1 if none is stored."""
    keys = as_columns(keys)
    highest = stored.groupBy(*keys).agg(F.max(version_number(F.col(version))).alias("__max"))
    joined = join_null_safe(df.drop(version), highest, keys, "left")
    return joined.withColumn(version, F.when(F.col("__max").isNull(), 1).otherwise(F.greatest(F.col("__max"), F.lit(1)) + 1).cast("int")).drop("__max")


def split_by_receiver(
    df: DataFrame, receivers: DataFrame, keys, order, receiver: str = "receiver", value: str = "value", decimals: int = 1
) -> DataFrame:
    """Rows of known receivers, newest per key, non-null, rounded.  Write with `partitionBy(receiver)`."""
    keys = as_columns(keys)
    known = df.join(receivers.select(receiver).distinct(), receiver, "left_semi").where(F.col(value).isNotNull())
    newest = dedupe_last(known, [receiver, *keys], order)
    return newest.withColumn(value, F.round(value, decimals)) if decimals >= 0 else newest
