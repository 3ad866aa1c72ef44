"""Exact order statistics and counts without one task per group.

A group (a product, a region) may hold a third of all rows, so nothing here
sorts a whole group in one task.  Rows are first reduced to (group, value,
weight) with map-side combine.  These are dealt by ranges of (group, value),
whose splitters Spark takes from a sample of the data itself, so that any crowd
of values, wherever it lies, spreads over all tasks.  The dealt table is written
once; totals per group and range, summed up in the order of the ranges, say how
many rows lie before each (the directory, a row per range and group).  A rank or
a threshold is then located in the directory, and only the ranges that hold one
are sorted, each in a task of its own.

A `Distribution` answers any number of such questions; build it once and pass it
to the operators instead of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headroom.scale import as_columns, cut_lineage, drop_scratch, join_null_safe


def value_counts(df: DataFrame, value: str, by=None, weight: str | None = None) -> DataFrame:
    """(by…, value, weight): how often each non-null value occurs per group."""
    by = as_columns(by)
    kept = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return kept.groupBy(*by, F.col(value).cast("double").alias("value")).agg(total.cast("bigint").alias("weight"))


class Distribution:
    """The values of a table per group, in ranges with known totals.

    `rows`: (by…, value, weight, __part); `directory`: (by…, __part, low, before, upto, n), a row per
    group and range with the rows before it, up to its end and in the whole group.
    """

    def __init__(self, counts: DataFrame, by=None, split: bool | None = None):
        """`counts` as `value_counts` gives them.  `split=False` says that every group is known to be small: one range each, nothing is written."""
        self.by = as_columns(by)
        if split is False:
            self.rows = counts.withColumn("__part", F.lit(0))
            self.directory = self._directory()
        else:
            self.rows = cut_lineage(counts.repartitionByRange(*self.by, "value").withColumn("__part", F.spark_partition_id()))
            self.directory = cut_lineage(self._directory())
        self.stored = split is not False

    def _directory(self) -> DataFrame:
        totals = self.rows.groupBy(*self.by, "__part").agg(F.min("value").alias("low"), F.sum("weight").alias("__rows"))
        group = W.partitionBy(*self.by)
        running = F.sum("__rows").over(group.orderBy("__part").rowsBetween(W.unboundedPreceding, W.currentRow))
        return totals.select(*self.by, "__part", "low", (running - F.col("__rows")).alias("before"), running.alias("upto"), F.sum("__rows").over(group).alias("n"))

    def sizes(self) -> DataFrame:
        """(by…, n): non-null rows per group."""
        return self.directory.groupBy(*self.by).agg(F.max("n").alias("n"))

    def drop(self) -> None:
        """Delete the written tables, once nothing lazy reads them any more."""
        if self.stored:
            drop_scratch(self.rows)
            drop_scratch(self.directory)

    def _wanted(self, placed: DataFrame) -> DataFrame:
        """Rows of the ranges that hold a question."""
        keys = [*self.by, "__part"]
        return join_null_safe(self.rows, placed.select(*keys).where("__part is not null").distinct(), keys, "left_semi")

    def values_at(self, targets: DataFrame) -> DataFrame:
        """Targets (by…, rank, …) with the value at that 0-based rank of their group; null outside the group."""
        by, extra = self.by, [c for c in targets.columns if c not in self.by and c != "rank"]
        targets = targets.withColumn("rank", F.col("rank").cast("bigint"))
        starts = self.directory.select(*by, F.col("before").alias("rank"), "__part", F.col("before").alias("__before"))
        placed = _last_at_or_before(starts, targets, by, "rank", ["__part", "__before"]).withColumn("__local", F.col("rank") - F.col("__before"))
        keys = [*by, "__part"]
        upto = F.sum("weight").over(W.partitionBy(*keys).orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow))
        ordered = self._wanted(placed).select(*keys, "value", upto.alias("__end"), (upto - F.col("weight")).alias("__local"))
        found = _last_at_or_before(ordered, placed.select(*keys, "__local", "rank", *extra), keys, "__local", ["value", "__end"])
        inside = (F.col("__local") >= 0) & (F.col("__local") < F.col("__end"))
        return found.select(*by, "rank", *extra, F.when(inside, F.col("value")).alias("value"))

    def counts_at(self, thresholds: DataFrame) -> DataFrame:
        """Thresholds (by…, value, …) with `n_below` (<) and `n_upto` (<=) rows of their group."""
        by, extra = self.by, [c for c in thresholds.columns if c not in self.by and c != "value"]
        asked = thresholds.withColumn("value", F.col("value").cast("double"))
        starts = self.directory.select(*by, F.col("low").alias("value"), "__part", F.col("before").alias("__before"))
        placed = _last_at_or_before(starts, asked, by, "value", ["__part", "__before"]).withColumn("__base", F.coalesce("__before", F.lit(0)))
        keys = [*by, "__part"]
        left = self._wanted(placed).select(
            *keys, "value", "weight", F.lit(0).alias("__asked"), F.lit(0).cast("bigint").alias("__base"),
            *[F.lit(None).cast(thresholds.schema[c].dataType).alias(c) for c in extra],
        )
        right = placed.select(*keys, "value", F.lit(0).cast("bigint").alias("weight"), F.lit(1).alias("__asked"), "__base", *extra)
        order = W.partitionBy(*keys).orderBy("value")
        upto = F.sum("weight").over(order.rangeBetween(W.unboundedPreceding, W.currentRow))
        equal = F.sum("weight").over(order.rangeBetween(W.currentRow, W.currentRow))
        return (
            left.unionByName(right)
            .withColumns({"__n": upto, "__equal": equal})
            .where("__asked = 1")
            .select(
                *by, "value", *extra,
                (F.col("__base") + F.col("__n") - F.col("__equal")).alias("n_below"),
                (F.col("__base") + F.col("__n")).alias("n_upto"),
            )
        )


def distribution_of(df, value: str, by=None, weight: str | None = None, split: bool | None = None, decimals: int | None = None) -> Distribution:
    """`df` itself if it is a `Distribution`, else that of its `value` column, rounded to `decimals` if given."""
    if isinstance(df, Distribution):
        return df
    if decimals is not None:
        df = df.withColumn(value, F.round(F.col(value).cast("double"), decimals))
    return Distribution(value_counts(df, value, by, weight), by, split)


def _last_at_or_before(known: DataFrame, asked: DataFrame, by: list[str], position: str, carry: list[str]) -> DataFrame:
    """`asked` rows with the `carry` fields of the last `known` row at or before `position`."""
    extra = [c for c in asked.columns if c not in by and c != position]
    left = known.select(
        *by, position, F.lit(0).alias("__asked"), F.struct(*carry).alias("__carry"),
        *[F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in extra],
    )
    right = asked.select(
        *by, position, F.lit(1).alias("__asked"),
        F.lit(None).cast(known.select(F.struct(*carry).alias("s")).schema["s"].dataType).alias("__carry"), *extra,
    )
    order = W.partitionBy(*by).orderBy(position, "__asked").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        left.unionByName(right)
        .withColumn("__carry", F.last("__carry", ignorenulls=True).over(order))
        .where("__asked = 1")
        .select(*by, position, *extra, *[F.col(f"__carry.{c}").alias(c) for c in carry])
    )


def group_sizes(counts: DataFrame, by=None) -> DataFrame:
    """(by…, n): non-null rows per group."""
    return counts.groupBy(*as_columns(by)).agg(F.sum("weight").alias("n"))


def values_at_ranks(counts: DataFrame, targets: DataFrame, by=None, split: bool | None = None) -> DataFrame:
    """`Distribution.values_at` of value counts that serve one look-up only."""
    return Distribution(counts, by, split).values_at(targets)


def counts_at_values(counts: DataFrame, thresholds: DataFrame, by=None, split: bool | None = None) -> DataFrame:
    """`Distribution.counts_at` of value counts that serve one look-up only."""
    return Distribution(counts, by, split).counts_at(thresholds)
