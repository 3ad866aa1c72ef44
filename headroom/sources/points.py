"""Point tables: scans, filter specs, nested documents, time chunks."""

from __future__ import annotations

import functools
import operator
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headroom.functions.durations import duration_seconds
from headroom.operators.columns import quoted
from headroom.scale import as_columns, epoch, time_literal


def scan_points(spark: SparkSession, path: str, fields: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """All rows of a stored table, nested fields flattened to dotted columns."""
    return flatten_nested(spark.read.format(fmt).load(path), fields)


def scan_time_range(df: DataFrame, start=None, end=None, keys="valid_from", month: str | None = None) -> DataFrame:
    """Rows by time: one key is half-open [start, end); two keys are from ≥ start and to ≤ end.

    Bounds are cast to the column's own type, so the filter reaches the Parquet
    scan.  `month` names the partition column of a table partitioned by
    yyyy-MM; the bounds then prune partitions too (one key, or the first of two).
    """
    keys = as_columns(keys)

    def bound(value, key: str) -> Column:
        return time_literal(value, df.schema[key].dataType.simpleString())

    if start is not None:
        df = df.where(quoted(keys[0]) >= bound(start, keys[0]))
        if month:
            df = df.where(F.col(month) >= F.date_format(time_literal(start), "yyyy-MM"))
    if end is not None:
        last = quoted(keys[-1])
        df = df.where(last < bound(end, keys[0]) if len(keys) == 1 else last <= bound(end, keys[-1]))
        if month:
            df = df.where(F.col(month) <= F.date_format(time_literal(end), "yyyy-MM"))
    return df


def _any_of(tests: list[Column]) -> Column:
    return functools.reduce(operator.or_, tests)


def _all_of(tests: list[Column]) -> Column:
    return functools.reduce(operator.and_, tests, F.lit(True))


def spec_condition(df: DataFrame, spec) -> Column:
    """Predicate of a filter spec (see `filter_by_spec`)."""
    if isinstance(spec, list):
        return _all_of([spec_condition(df, s) for s in spec])
    tests = []
    for key, value in spec.items():
        if value is None:
            continue
        if key == "bool":
            tests.append(spec_condition(df, value))
        elif key in ("must", "filter"):
            tests.append(spec_condition(df, value if isinstance(value, list) else [value]))
        elif key == "should":
            tests.append(_any_of([spec_condition(df, s) for s in (value if isinstance(value, list) else [value])]))
        elif key == "must_not":
            # a row without the field is not excluded
            tests += [~F.coalesce(spec_condition(df, s), F.lit(False)) for s in (value if isinstance(value, list) else [value])]
        elif key in ("match", "term"):
            tests.append(spec_condition(df, value))
        elif key == "range":
            for name, bounds in value.items():
                kind = df.schema[name].dataType
                compare = {"gte": operator.ge, "gt": operator.gt, "lte": operator.le, "lt": operator.lt}
                tests += [compare[op](quoted(name), time_literal(b, kind.simpleString())) for op, b in bounds.items()]
        elif key == "exists":
            tests.append(quoted(value["field"]).isNotNull())
        elif key == "match_all":
            continue
        else:
            name = key.removesuffix(".keyword") if key not in df.columns else key
            kind = df.schema[name].dataType
            options = [F.lit(v).try_cast(kind) for v in (value if isinstance(value, (list, tuple)) else [value])]
            tests.append(quoted(name) == options[0] if len(options) == 1 else quoted(name).isin(options))
    return _all_of(tests)


def filter_by_spec(df: DataFrame, spec: dict, *more: dict) -> DataFrame:
    """Rows meeting a dict spec; further specs are ANDed.  Plain comparisons, so they reach the scan.

    `{column: value}` pairs are ANDed and a list means OR; the keys `bool`,
    `must`, `should`, `must_not`, `filter`, `range` and `exists` nest.
    """
    return df.where(_all_of([spec_condition(df, s) for s in (spec, *more)]))


def list_lengths(df: DataFrame, fields: list[str] | None = None) -> dict[str, int]:
    """Longest list per array path in the schema, found by one aggregate over the table.

    With `fields` only the lists these names reach into are measured; the others
    count as empty, and without any no job is started.
    """
    lengths: dict[str, Column] = {}
    asked = None if fields is None else {".".join(p for p in f.split(".") if not p.isdigit()) for f in fields if any(p.isdigit() for p in f.split("."))}

    def field_of(column: Column, name: str, lifted: bool) -> Column:
        return F.transform(column, lambda x: x.getField(name)) if lifted else column.getField(name)

    def walk(column: Column, kind: T.DataType, path: str, lifted: bool) -> None:
        # `lifted`: the column holds an array of the values at this path
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                walk(field_of(column, field.name, lifted), field.dataType, f"{path}.{field.name}", lifted)
        elif isinstance(kind, T.ArrayType):
            if asked is None or any(f == path or f.startswith(f"{path}.") for f in asked):
                lengths[path] = F.array_max(F.transform(column, F.size)) if lifted else F.size(column)
            walk(F.flatten(column) if lifted else column, kind.elementType, path, True)

    for field in df.schema.fields:
        walk(quoted(field.name), field.dataType, field.name, False)
    if not lengths:
        return {}
    longest = df.agg(*[F.max(c).alias(str(i)) for i, c in enumerate(lengths.values())]).first()
    return {path: max(longest[i] or 0, 0) for i, path in enumerate(lengths)}


def flatten_nested(df: DataFrame, fields: list[str] | None = None, lengths: dict[str, int] | None = None) -> DataFrame:
    """Struct fields as dotted columns, list items as `name.1`, `name.2`…

    The schema decides the columns, and for lists the longest list in the table
    (`lengths`, measured by `list_lengths` when not given).  `fields` keeps only
    these dotted names, which prunes the scan.
    """
    columns: list[tuple[str, Column]] = []
    if lengths is None:
        lengths = list_lengths(df, fields)

    def walk(column: Column, kind: T.DataType, name: str, path: str) -> None:
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                walk(column.getField(field.name), field.dataType, f"{name}.{field.name}", f"{path}.{field.name}")
        elif isinstance(kind, T.ArrayType):
            for i in range(1, lengths.get(path, 0) + 1):
                walk(F.try_element_at(column, F.lit(i)), kind.elementType, f"{name}.{i}", path)
        else:
            columns.append((name, column))

    for field in df.schema.fields:
        walk(quoted(field.name), field.dataType, field.name, field.name)
    return df.select(*[c.alias(n) for n, c in columns if fields is None or n in fields])


def flatten_long(df: DataFrame, keys) -> DataFrame:
    """(keys…, path, position, value, number): a row per leaf value of the other columns.

    `path` is dotted, `position` holds the 1-based places in the lists on the way
    (empty without lists), `number` the value where it is one.  Null leaves are
    left out.  One pass; no list has to be measured first.
    """
    keys = as_columns(keys)
    leaf = "array<struct<path:string,position:array<int>,value:string>>"
    none = F.array().cast(leaf)

    def entries(column: Column, kind: T.DataType, path: str, places: Column) -> Column:
        if isinstance(kind, T.StructType):
            parts = [entries(column.getField(f.name), f.dataType, f"{path}.{f.name}", places) for f in kind.fields]
            return F.concat(*parts) if parts else none
        if isinstance(kind, T.ArrayType):
            each = F.transform(column, lambda x, i: entries(x, kind.elementType, path, F.concat(places, F.array((i + 1).cast("int")))))
            return F.coalesce(F.flatten(each), none)
        one = F.struct(F.lit(path).alias("path"), places.alias("position"), column.cast("string").alias("value"))
        return F.when(column.isNotNull(), F.array(one)).otherwise(none)

    top = F.array().cast("array<int>")
    found = F.concat(*[entries(quoted(f.name), f.dataType, f.name, top) for f in df.schema.fields if f.name not in keys])
    rows = df.select(*[quoted(k) for k in keys], F.inline(found))
    return rows.withColumn("number", F.col("value").try_cast("double"))


def nest_columns(df: DataFrame, delimiter: str = ".") -> DataFrame:
    """Dotted columns back to nested structs."""
    tree: dict = {}
    for name in df.columns:
        node, parts = tree, name.split(delimiter)
        for part in parts[:-1]:
            node = node.setdefault(part, {})
        node[parts[-1]] = name

    def build(node: dict) -> list[Column]:
        return [
            (F.struct(*build(value)) if isinstance(value, dict) else quoted(value)).alias(key) for key, value in node.items()
        ]

    return df.select(*build(tree))


def nested_json(df: DataFrame, delimiter: str = ".") -> DataFrame:
    """One JSON document per row from dotted columns."""
    nested = nest_columns(df, delimiter)
    return nested.select(F.to_json(F.struct(*[quoted(c) for c in nested.columns])).alias("document"))


def time_chunks(spark: SparkSession, start: datetime, end: datetime, step: str | int | None) -> DataFrame:
    """(chunk, chunk_from, chunk_to): [start, end) in steps, the last one shorter."""
    seconds = duration_seconds(step) if step is not None else int((end - start).total_seconds())
    count = max(1, -(-int((end - start).total_seconds()) // seconds))
    width = timedelta(seconds=seconds)
    first = time_literal(start, "timestamp_ntz")
    return (
        spark.range(count)
        .select(
            F.col("id").alias("chunk"),
            (first + F.col("id") * F.lit(width)).alias("chunk_from"),
            F.least(
                first + (F.col("id") + 1) * F.lit(width), time_literal(end, "timestamp_ntz")
            ).alias("chunk_to"),
        )
    )


def tag_chunks(df: DataFrame, start: datetime, end: datetime, step: str | int, time: str = "valid_from") -> DataFrame:
    """Rows of [start, end) with the number of their chunk, by arithmetic rather than a range join."""
    inside = scan_time_range(df, start, end, time)
    first = epoch(time_literal(start))
    return inside.withColumn("chunk", F.floor((epoch(time) - first) / duration_seconds(step)).cast("bigint"))
