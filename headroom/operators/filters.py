"""Row filters."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headroom.functions.numbers import version_number
from headroom.functions.times import to_zone
from headroom.scale import as_columns, join_null_safe, time_literal


def filter_equals(df: DataFrame, pairs: dict) -> DataFrame:
    """AND of equalities; a None or NaN key selects nulls."""
    tests = [F.col(c).isNull() if v is None or v != v else F.col(c).eqNullSafe(F.lit(v)) for c, v in pairs.items()]
    return df.where(functools.reduce(operator.and_, tests, F.lit(True)))


def filter_contains(df: DataFrame, words: dict[str, str | list[str]]) -> DataFrame:
    """Rows whose value contains any keyword, case-insensitive; a column without any hit does not filter.

    Whether there is a hit at all is a one-row scalar subquery.
    """
    for name, keys in words.items():
        if name not in df.columns:
            continue
        lowered = F.lower(F.col(name).cast("string"))
        test = functools.reduce(operator.or_, [F.contains(lowered, F.lit(k.lower())) for k in as_columns(keys)])
        hit = df.agg(F.coalesce(F.bool_or(test), F.lit(False)).alias("hit")).scalar()
        df = df.where(F.coalesce(test, F.lit(False)) | ~hit)
    return df


def filter_group_extreme(df: DataFrame, conditions: dict[str, str], group) -> DataFrame:
    """Rows equal to an aggregate (`max`, `min`, `mean`, `sum`…) of their group; all conditions must hold.

    The aggregate is computed with map-side combine and joined back, so a group
    that holds most rows is never gathered in one task.
    """
    from headroom.registry import aggregate

    group = as_columns(group)
    wanted = {c: how for c, how in conditions.items() if c in df.columns}
    if not wanted:
        return df
    best = df.groupBy(*group).agg(*[aggregate(how)(F.col(c)).alias(f"__best_{c}") for c, how in wanted.items()])
    joined = join_null_safe(df, best, group)
    return joined.where(functools.reduce(operator.and_, [F.col(c) == F.col(f"__best_{c}") for c in wanted])).select(*df.columns)


def pick_group_argmax(df: DataFrame, group, by: str, how: str = "max", tie=None, keep_null_group: bool = True) -> DataFrame:
    """One row per group at the largest (`max`) or smallest `by`; rows without a group stay.

    Spark limits each group to one row before the shuffle.
    """
    group, tie = as_columns(group), as_columns(tie)
    grouped = functools.reduce(operator.and_, [F.col(g).isNotNull() for g in group])
    order = F.col(by).desc_nulls_last() if how == "max" else F.col(by).asc_nulls_last()
    ranked = df.where(grouped & F.col(by).isNotNull()).withColumn(
        "__rn", F.row_number().over(W.partitionBy(*group).orderBy(order, *tie))
    )
    best = ranked.where("__rn = 1").drop("__rn")
    return best.unionByName(df.where(~grouped)) if keep_null_group else best


def slice_time(df: DataFrame, bounds, time: str = "valid_from") -> DataFrame:
    """Rows between the smallest and largest of the given bounds, both included."""
    kind = df.schema[time].dataType.simpleString()
    known = [time_literal(b, kind) for b in bounds if b is not None]
    if not known:
        raise ValueError("no time bound given")
    if len(known) == 1:
        return df.where(F.col(time) == known[0])
    return df.where(F.col(time).between(F.least(*known), F.greatest(*known)))


def slice_time_of_day(df: DataFrame, slices: DataFrame, time: str = "valid_from", position: str = "position") -> DataFrame:
    """Rows tagged with every slice that holds their local time of day (ends included, may wrap midnight).

    `slices` is a parameter table (position, start_time, end_time, time_zone) of
    a few rows; slices without times take every row.  Its content becomes one
    array literal, so the big table is neither shuffled nor joined.
    """
    rows = slices.select(position, "start_time", "end_time", "time_zone").collect()  # bounded: slices of a day
    tagged = df.drop(position)
    hits = []
    for row in rows:
        if row.start_time is None or row.end_time is None:
            hits.append(F.lit(row[position]))
            continue
        clock = F.date_format(to_zone(F.col(time), row.time_zone), "HH:mm:ss")
        low, high = F.lit(row.start_time), F.lit(row.end_time)
        inside = clock.between(low, high) if row.start_time <= row.end_time else (clock >= low) | (clock <= high)
        hits.append(F.when(inside, F.lit(row[position])))
    return tagged.withColumn(position, F.explode(F.array_compact(F.array(*hits))))


def negative_policy(df: DataFrame, policy: str, value: str = "value", product=None, time=("valid_from", "valid_to")) -> DataFrame:
    """`cut`: drop every time at which some product is negative or missing; `zero`: negatives to 0; `none`.

    Input has one row per time and product.
    """
    if policy == "zero":
        return df.withColumn(value, F.when(F.col(value) < 0, F.lit(0.0)).otherwise(F.col(value)))
    if policy != "cut":
        return df
    product, time = as_columns(product), as_columns(time)
    known = df.where(F.col(value).isNotNull())
    products = known.select(F.count_distinct(F.struct(*product)).alias("n")).scalar()
    # a time holds one row per product, so this partition is as wide as the product list
    good = F.count_if(F.col(value) >= 0).over(W.partitionBy(*time))
    return df.withColumn("__good", good).where(F.col("__good") == products).drop("__good")


def filter_send_levels(df: DataFrame, start: float, end: float, step: float = 1, level: str = "percentage_level") -> DataFrame:
    """Rows whose level is one of start, start+step … end (whole numbers)."""
    levels = list(range(int(start), int(end) + int(step), int(step)))
    return df.where(F.col(level).isin([float(x) for x in levels]))


def latest_version(
    df: DataFrame, variable_words: list[str] | None = None, fixed_cols: list[str] | None = None, key: str = "version"
) -> DataFrame:
    """Rows holding the highest version of their group, ties kept.

    The group is `fixed_cols`, or all columns whose name has none of
    `variable_words`; nulls form a group.  Versions compare as whole numbers
    (`2.0` is 2); a group without any number keeps all its rows.
    """
    column = next(c for c in df.columns if key.lower() in c.lower())
    if fixed_cols is None:
        words = variable_words if variable_words is not None else VARIABLE_WORDS
        fixed_cols = [c for c in df.columns if not any(w.lower() in c.lower() for w in words)]
    number = version_number(F.col(column))
    best = df.groupBy(*fixed_cols).agg(F.max(number).alias("__best"))
    return join_null_safe(df, best, fixed_cols).where(number.eqNullSafe(F.col("__best"))).select(*df.columns)


# Name parts of columns that differ between versions of one result.
VARIABLE_WORDS = [
    "timestamp", "version", "available.value", "calculation_date", "mrid", "index", "@timestamp", "sender.mRID", "description",
]


def results_by_type(df: DataFrame, result_type: str | None, version=None, variable_words=None, fixed_cols=None, key: str = "version") -> DataFrame:
    """Rows of one result type, latest or given version, all-null columns dropped (one aggregate job)."""
    from headroom.operators.columns import drop_columns

    rows = df if result_type is None else df.where(F.col("result_type") == result_type)
    if version is None:
        rows = latest_version(rows, variable_words, fixed_cols, key)
    else:
        column = next(c for c in df.columns if key.lower() in c.lower())
        rows = rows.where(F.col(column) == F.lit(version))
    return drop_columns(rows)


def data_range(df: DataFrame, start, end, time: str = "valid_from", time_end: str | None = None) -> DataFrame:
    """One row: the requested period clamped to what the table holds."""
    kind = df.schema[time].dataType.simpleString()
    return df.agg(
        F.greatest(F.min(time), time_literal(start, kind)).alias("period_start"),
        F.least(F.max(time_end or time), time_literal(end, kind)).alias("period_end"),
    )


def dedupe_last(df: DataFrame, keys, order) -> DataFrame:
    """Last row per key in the given order (limited per key before the shuffle)."""
    keys, order = as_columns(keys), as_columns(order)
    window = W.partitionBy(*keys).orderBy(*[F.col(o).desc_nulls_last() for o in order])
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def latest_per_sender(df: DataFrame, sender="sender", received: str = "received", tie=None) -> DataFrame:
    """Newest row per sender (or per sender and product)."""
    return dedupe_last(df, sender, [received, *as_columns(tie)])


def whitelist_products(df: DataFrame, dims: dict[str, list | dict]) -> DataFrame:
    """Rows whose product columns all lie in the given dimensions; a dict also renames the values.

    The product of the dimensions is the AND of one membership test per column.
    """
    for name, allowed in dims.items():
        df = df.where(F.col(name).isin(list(allowed)))
        if isinstance(allowed, dict):
            names = F.create_map(*[F.lit(x) for pair in allowed.items() for x in pair])
            df = df.withColumn(name, F.element_at(names, F.col(name)))
    return df


def single_value(df: DataFrame, column: str, strict: bool = True) -> DataFrame:
    """One row: the value of a column if unique, else null; not strict: any value if there are several."""
    lowest, count = F.min(column), F.count_distinct(F.col(column)) + F.max(F.col(column).isNull().cast("int"))
    return df.agg(F.when(count == 1 if strict else count > 1, lowest).alias(column))


def clear_text_nan(df: DataFrame, columns) -> DataFrame:
    """The text 'nan' and numeric NaN become null."""
    kinds = dict(df.dtypes)

    def cleaned(name: str) -> Column:
        if kinds[name] in ("double", "float"):
            return F.when(~F.isnan(name), F.col(name))
        return F.when(F.col(name) != "nan", F.col(name))

    return df.withColumns({c: cleaned(c) for c in as_columns(columns)})
