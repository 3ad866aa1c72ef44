"""Combining long tables (time × product -> value).

A time is kept only if every input has it (inner); a product that only one
input has passes through unchanged.  All inputs go through one shuffle by
time, after which both the presence test and the per-product combination are
local to a partition.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headroom.scale import as_columns, cut_lineage, drop_scratch, epoch, join_null_safe


def pivot_products(df: DataFrame, value: str, by, time=("valid_from", "valid_to"), how: str = "sum") -> DataFrame:
    """One row per time and product.  `sum` over nulls only is 0; `mean`, `min`, `max` drop such cells.

    Rows with a null time or product vanish.
    """
    from headroom.registry import aggregate

    keys = [*as_columns(time), *as_columns(by)]
    kept = df.dropna(subset=keys)
    result = aggregate(how)(F.col(value))
    if how == "sum":
        return kept.groupBy(*keys).agg(F.coalesce(result, F.lit(0.0)).alias("value"))
    return kept.groupBy(*keys).agg(result.alias("value")).where("value is not null")


def widen(df: DataFrame, by, names: list[str], value: str = "value", time=("valid_from", "valid_to")) -> DataFrame:
    """Output form: one column per known product name."""
    labelled = df.withColumn("__product", F.concat_ws("_", *as_columns(by)))
    return labelled.groupBy(*as_columns(time)).pivot("__product", names).agg(F.first(value))


def _combine(tables: list[DataFrame], by, time, how: str, pair, propagate: bool = False) -> DataFrame:
    """Tables of one row per time and product, combined by `pair`; should a table have several, the greatest value counts."""
    by, time = as_columns(by), as_columns(time)
    if not tables:
        raise ValueError("nothing to combine")
    if len(tables) == 1:
        return tables[0]
    count = len(tables)
    tagged = functools.reduce(
        DataFrame.unionByName,
        [t.select(*time, *by, "value", F.lit(i).alias("__table")) for i, t in enumerate(tables)],
    )
    at_time = W.partitionBy(*time)
    seen = [F.max(F.col("__table") == i).over(at_time) for i in range(count)]
    if how == "inner":
        keep = functools.reduce(lambda a, b: a & b, seen)
    elif how == "left":
        keep = seen[0]
    else:
        keep = F.lit(True)
    # the partitioning by time also serves this grouping: no second shuffle
    cells = tagged.withColumn("__keep", keep).where("__keep").groupBy(*time, *by).agg(
        *[F.max(F.when(F.col("__table") == i, F.col("value"))).alias(f"__v{i}") for i in range(count)],
        *([] if propagate else [F.max(F.col("__table") == i).alias(f"__p{i}") for i in range(count)]),
    )
    if propagate:
        # a product counts as present if the table has it at any time: its gaps then are nulls
        has = tagged.groupBy(*by).agg(*[F.max(F.col("__table") == i).alias(f"__p{i}") for i in range(count)])
        cells = join_null_safe(cells, has, by) if by else cells.withColumns({f"__p{i}": F.lit(True) for i in range(count)})
    value, present = F.col("__v0"), F.col("__p0")
    for i in range(1, count):
        v, p = F.col(f"__v{i}"), F.col(f"__p{i}")
        value = F.when(present & p, pair(value, v)).when(present, value).otherwise(v)
        present = present | p
    return cells.select(*time, *by, value.alias("value"))


def _add(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


def combine_add(tables, by=None, time=("valid_from", "valid_to"), how: str = "inner", **_) -> DataFrame:
    """Sum per time and product, skipping nulls."""
    return _combine(tables, by, time, how, _add)


def combine_subtract(tables, by=None, time=("valid_from", "valid_to"), how: str = "inner", **_) -> DataFrame:
    """First table minus the others; a null on either side gives null."""
    return _combine(tables, by, time, how, lambda a, b: a - b, propagate=True)


def combine_min(tables, by=None, time=("valid_from", "valid_to"), how: str = "inner", **_) -> DataFrame:
    """Smallest value per time and product, skipping nulls."""
    return _combine(tables, by, time, how, lambda a, b: F.least(a, b))


def combine_max(tables, by=None, time=("valid_from", "valid_to"), how: str = "inner", **_) -> DataFrame:
    """Largest value per time and product, skipping nulls."""
    return _combine(tables, by, time, how, lambda a, b: F.greatest(a, b))


def tree_leaves(tree: dict, operators: dict) -> list[dict]:
    """Filter specs of a tree, left to right."""
    name = next(iter(tree)) if len(tree) == 1 else None
    if name in operators and isinstance(tree[name], list):
        return [leaf for part in tree[name] for leaf in tree_leaves(part, operators)]
    return [tree]


def combine_tree(
    df: DataFrame, tree: dict, by, value: str, time=("valid_from", "valid_to"), how: str = "sum", replace: dict | None = None,
    align: bool = True, prepare: Callable[[DataFrame, list[str]], DataFrame] | None = None, steps: dict | None = None,
    operators: dict | None = None,
) -> DataFrame:
    """Value of a nested operator tree `{OP: [tree or filter, …]}` over one point table.

    A leaf is a filter spec; its rows may be thinned by `prepare(rows, keys)`
    (e.g. one bid per exclusive group and `keys`), step-filled (`steps` =
    arguments of `fill_steps`), renamed (`replace`) and pivoted.  Operands of
    an operator are aligned to the finest step among them first.

    All leaves are taken in one pass over the point table: a row is tagged with
    the leaves it belongs to.  The pivoted cells (time × product) and the result
    are written tables, so neither the big scan nor later plans repeat it.
    """
    from headroom.operators.columns import replace_values
    from headroom.operators.series import fill_steps, resample_table
    from headroom.registry import COMBINE
    from headroom.sources.points import spec_condition

    operators, by, time = operators or COMBINE, as_columns(by), as_columns(time)
    tests = [spec_condition(df, leaf) for leaf in tree_leaves(tree, operators)]
    member = F.array_compact(F.array(*[F.when(test, F.lit(i)) for i, test in enumerate(tests)]))
    rows = df.where(functools.reduce(lambda a, b: a | b, tests)).withColumn("__leaf", F.explode(member))
    if prepare:
        rows = prepare(rows, ["__leaf"])
    if steps:
        rows = fill_steps(rows, time=time, **{**steps, "types": [*as_columns(steps.get("types")), "__leaf"]})
    if replace:
        rows = replace_values(rows, replace)
    cells = cut_lineage(pivot_products(rows, value, ["__leaf", *by], time, how))
    length = F.abs(epoch(time[-1]) - epoch(time[0]))
    found = cells.groupBy("__leaf").agg(F.min(length).alias("step")).collect() if align else []  # one row per leaf
    leaf_steps = {row["__leaf"]: row.step for row in found}
    numbers = iter(range(len(tests)))

    def evaluate(node: dict) -> tuple[DataFrame, int | None, bool]:
        """(table, its step, whether it already lies on a gapless grid of that step)."""
        name = next(iter(node)) if len(node) == 1 else None
        if not (name in operators and isinstance(node[name], list)):
            number = next(numbers)
            return cells.where(F.col("__leaf") == number).drop("__leaf"), leaf_steps.get(number), False
        parts = [evaluate(part) for part in node[name]]
        known = [step for _, step, _ in parts if step]
        step = min(known) if known else None
        tables = [table for table, _, _ in parts]
        aligned = align and len(parts) > 1 and step is not None
        if aligned:
            tables = [
                table if done and own == step else resample_table(table, step, "value", by, *time) for table, own, done in parts
            ]
        return operators[name](tables, by=by, time=time, step=step if aligned else None), step, aligned

    table, _, _ = evaluate(tree)
    result = cut_lineage(table)
    drop_scratch(cells)
    return result
