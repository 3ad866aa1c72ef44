"""Set-like operators: union, distinct, append and update by key."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headroom.scale import as_columns, join_null_safe


def union_all(tables: list[DataFrame]) -> DataFrame:
    """Concatenate tables; missing columns are null."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def distinct_rows(df: DataFrame, keys=None, order=None) -> DataFrame:
    """One row per key: the first in `order`, or any when the rows are equal in all that matters."""
    keys = as_columns(keys)
    if not keys:
        return df.distinct()
    if order is None:
        return df.dropDuplicates(keys)
    from pyspark.sql import Window as W

    window = W.partitionBy(*keys).orderBy(*as_columns(order))
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def append_missing(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Old rows plus the new ones whose key the old table does not have."""
    keys = as_columns(keys)
    absent = join_null_safe(new, old.select(*keys).distinct(), keys, "left_anti")
    return old.unionByName(absent, allowMissingColumns=True)


def update_by_key(old: DataFrame, new: DataFrame, keys, insert: bool = True) -> DataFrame:
    """Non-null new fields overwrite the old ones of the same key; unknown keys are added if `insert`.

    Both sides meet in one grouping, so a key is never joined row by row.
    Keys are unique per table.
    """
    keys = as_columns(keys)
    fields = [*[c for c in old.columns if c not in keys], *[c for c in new.columns if c not in keys and c not in old.columns]]
    both = union_all([old.withColumn("__new", F.lit(0)), new.withColumn("__new", F.lit(1))])
    latest = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("__new"))).alias(c) for c in fields]
    merged = both.groupBy(*keys).agg(*latest, F.min("__new").alias("__new"))
    return (merged if insert else merged.where("__new = 0")).drop("__new").select(*keys, *fields)
