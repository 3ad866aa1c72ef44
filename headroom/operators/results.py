"""Result points: building, grouping to series, tables, headers, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headroom.functions.numbers import version_number
from headroom.functions.times import format_utc
from headroom.operators.capacity import limit_bids_by_capacity
from headroom.operators.columns import BUSINESS_TYPES, decode
from headroom.scale import as_columns, join_null_safe

# Business type of a proposed product.
PRODUCT_BUSINESS = {"aFRR": "A96", "mFRR": "A97", "ATC": "C01"}
# Codes of proposed and exceeded results (message, process).
RESULT_CODES = {
    ("NCPB", "proposed"): ("A24", "A14"), ("ATC", "proposed"): ("A26", "A14"),
    ("NCPB", "exceeded"): ("A24", "A37"), ("ATC", "exceeded"): ("A26", "A37"),
}


def points_from_quantiles(df: DataFrame, meta: dict, areas: DataFrame, result_type: str = "NCPB", kind: str = "proposed") -> DataFrame:
    """Long quantile rows -> result points with nested metadata; rows with a null value are left out.

    Input: percentage_level, value, position, valid_from, valid_to,
    point_resolution, number_of_points, spacing_start/step/stop, and area,
    product, direction (bids) or out_area, in_area (capacity).  `meta` gives
    data_from, data_to, data_resolution, calculation_date, version, sender,
    block and units.  `areas` is (mrid, name).
    """
    message, process = RESULT_CODES[(result_type, kind)]
    unit, level_unit = meta.get("unit", "MAW"), meta.get("level_unit", "P1")
    lookup = areas.select(F.col("name").alias("__name"), F.struct("name", "mrid").alias("__domain"))

    def domain(frame: DataFrame, column: str, into: str) -> DataFrame:
        named = lookup.withColumnsRenamed({"__name": f"__n_{into}", "__domain": into})
        return frame.join(named, frame[column] == F.col(f"__n_{into}"), "left").drop(f"__n_{into}")

    rows = df.where(F.col("value").isNotNull())
    if result_type == "NCPB":
        rows = domain(rows, "area", "domain")
        business = F.create_map(*[F.lit(x) for pair in PRODUCT_BUSINESS.items() for x in pair])
        code = F.when(F.upper("direction") == "UP", "A01").when(F.upper("direction") == "DOWN", "A02")
        special = [
            F.col("domain"), F.struct(F.col("direction").alias("name"), code.alias("code")).alias("direction"),
            F.struct(F.col("product").alias("name")).alias("type"), F.try_element_at(business, F.col("product")).alias("business_type"),
        ]
    else:
        rows = domain(domain(rows, "out_area", "out_domain"), "in_area", "in_domain")
        special = [
            F.col("in_domain"), F.col("out_domain"), F.struct(F.lit("ATC").alias("name")).alias("type"),
            F.lit(PRODUCT_BUSINESS["ATC"]).alias("business_type"),
        ]
    return rows.select(
        F.lit(result_type).alias("result_type"), F.lit(meta.get("data_resolution", "PT15M")).alias("data_resolution"),
        *[F.lit(meta.get(k)).alias(k) for k in ("data_from", "data_to", "calculation_date", "sender", "block")],
        "valid_from", "valid_to", "point_resolution", "number_of_points", F.lit(str(meta.get("version", 1))).alias("version_number"),
        F.struct("position", F.col("value"), F.lit(unit).alias("measurement_unit")).alias("available"),
        F.struct("position", F.col("percentage_level").alias("value"), F.lit(level_unit).alias("measurement_unit")).alias("percentage_level"),
        F.struct(
            F.col("spacing_start").alias("start_percentage"), F.col("spacing_step").alias("step_percentage"), F.col("spacing_stop").alias("stop_percentage")
        ).alias("quantile_spacing"),
        F.lit(message).alias("message_type"), F.lit(process).alias("process_type"), *special,
    )


def series_id(fields, delimiter: str = "_") -> Column:
    """Present fields joined, spaces replaced."""
    return F.regexp_replace(F.concat_ws(delimiter, *[F.col(f).cast("string") for f in as_columns(fields)]), " ", "_")


def series_from_points(df: DataFrame, series_fields, document_fields, point_fields=("position", "quantity"), delimiter: str = "_") -> DataFrame:
    """Points grouped to series (points sorted by position) with the document each belongs to.

    A series is bounded by its positions; documents are ids, so no document is
    gathered here.
    """
    point = F.struct(*as_columns(point_fields))
    keyed = df.withColumns({"series_key": series_id(series_fields, delimiter), "document_key": series_id(document_fields, delimiter)})
    return keyed.groupBy("document_key", "series_key").agg(F.array_sort(F.collect_list(point)).alias("points"))


def group_quantile_tables(df: DataFrame, keys, level: str, product, names: list[str], value: str = "value") -> DataFrame:
    """Stored points -> one quantile table per key (slice, spacing): a row per level, a column per product."""
    labelled = df.withColumn("__product", F.concat_ws("_", *as_columns(product)))
    return labelled.groupBy(*as_columns(keys), level).pivot("__product", names).agg(F.min(value))


def result_headers(
    df: DataFrame, keys, start: str = "valid_from", end: str = "valid_to", version: str = "version_number", uniform=()
) -> DataFrame:
    """One row per header key: earliest start, latest end, highest version, and fields that have one value only."""

    def single(name: str) -> Column:
        same = (F.min(name) == F.max(name)) & (F.count(name) == F.count(F.lit(1)))
        return F.when(same, F.min(name)).alias(name)

    return df.groupBy(*as_columns(keys)).agg(
        F.min(start).alias(start), F.max(end).alias(end), F.max(version_number(F.col(version))).alias(version),
        *[single(u) for u in as_columns(uniform)],
    )


def proposed_vs_realised_report(
    proposed: DataFrame, realised: DataFrame, keys, level: str, operator: str = "operator", capacity: tuple | None = None, bridge: DataFrame | None = None
) -> DataFrame:
    """Realised rows with the proposed value beside them, by slice, operator and level.

    `capacity` = (proposed capacity, realised capacity) limits both first.
    """
    keys = as_columns(keys)
    if capacity is not None:
        shared = [k for k in [*keys, level] if k not in ("area", "direction", "product")]
        proposed = limit_bids_by_capacity(proposed, capacity[0], bridge, shared)
        realised = limit_bids_by_capacity(realised, capacity[1], bridge, shared)
    left = realised.select(*keys, level, operator, F.col("value").alias("realised"))
    right = proposed.select(*keys, level, F.col("value").alias("proposed"))
    return sort_report(join_null_safe(left, right, [*keys, level], "left"), [*keys, operator, level])


def sort_report(df: DataFrame, order) -> DataFrame:
    """Report in order of validity, operator and level."""
    return df.orderBy(*as_columns(order))


def business_name(column: Column) -> Column:
    """Name of a business type code."""
    return decode(column, BUSINESS_TYPES)


def document_period(start: str, end: str, block: str) -> Column:
    """Readable id of a result document."""
    return F.concat_ws("_", F.lit("from"), format_utc(F.col(start)), F.lit("to"), format_utc(F.col(end)), F.lit("for"), F.col(block))
