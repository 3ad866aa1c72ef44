"""Area dimension: names, codes, borders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headroom.scale import as_columns, literal_table

# Bidding areas with their operators, and the control block.
AREA_ROWS = [
    ("10Y1001A1001A39I", "Estonia", "EE", "10X1001A1001A39W", "Elering"),
    ("10YLV-1001A00074", "Latvia", "LV", "10X1001A1001B54W", "AST"),
    ("10YLT-1001A0008Q", "Lithuania", "LT", "10X1001A1001A55Y", "LITGRID"),
]
BLOCK_ROW = ("10Y1001A1001A94A", "Baltics")
AREA_SCHEMA = "mrid string, name string, code string, party_mrid string, party_name string"

# Area and direction -> the two borders that limit it (out, in).
CORRECTION_ROWS = [
    ("Estonia", "UP", "EE", "LV"), ("Estonia", "UP", "LV", "LT"),
    ("Estonia", "DOWN", "LT", "LV"), ("Estonia", "DOWN", "LV", "EE"),
    ("Latvia", "UP", "LV", "EE"), ("Latvia", "UP", "LV", "LT"),
    ("Latvia", "DOWN", "EE", "LV"), ("Latvia", "DOWN", "LT", "LV"),
    ("Lithuania", "UP", "LT", "LV"), ("Lithuania", "UP", "LV", "EE"),
    ("Lithuania", "DOWN", "EE", "LV"), ("Lithuania", "DOWN", "LV", "LT"),
]
GRAM = 3  # characters of an index entry of `align_labels`
CORRECTION_SCHEMA = "area string, direction string, out_area string, in_area string"


def default_areas(spark) -> DataFrame:
    return literal_table(spark, AREA_ROWS, AREA_SCHEMA)


def correction_keys(spark, rows=None) -> DataFrame:
    """The bridge table area × direction -> border; six pairs of two."""
    return literal_table(spark, rows or CORRECTION_ROWS, CORRECTION_SCHEMA)


def align_labels(df: DataFrame, columns, areas: DataFrame, attribute: str = "name", order: str = "mrid") -> DataFrame:
    """Labels replaced by an attribute of the first area (in `order`) they match; others stay.

    A label matches an area if it equals its id, code or operator id, or
    contains its name or operator name (case-insensitive).  Containment goes
    through an index: each name is filed under its rarest `GRAM` characters, a
    label asks for each of its own, once, and what meets is compared.  So a label
    costs rows by its own length only, and no label meets every area.
    """
    have = set(areas.columns)
    keys = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull(), F.struct(F.upper(c).alias("key"), F.lit(whole).alias("whole")))
        for c, whole in (("mrid", True), ("name", False), ("party_mrid", True), ("party_name", False), ("code", True)) if c in have
    ]))
    known = areas.select(F.col(order).alias("__order"), F.col(attribute).alias("__found"), F.inline(keys)).where("key <> ''")
    names = known.where("not whole").drop("whole")
    width = F.least(F.lit(GRAM), names.agg(F.min(F.length("key")).alias("n")).select("n").scalar())

    def cut_up(table: DataFrame, text: str) -> DataFrame:
        """`table` with a row for each different run of `__width` characters of `text`."""
        sized = table.withColumn("__width", width.cast("int")).where(F.length(text) >= F.col("__width"))
        places = F.sequence(F.lit(1), F.length(text) - F.col("__width") + 1)
        return sized.withColumn("gram", F.explode(F.array_distinct(F.transform(places, lambda i: F.substr(F.col(text), i, F.col("__width"))))))

    cut = cut_up(names.select("key").distinct(), "key")
    seldom = cut.join(cut.groupBy("gram").agg(F.count("*").alias("n")), "gram").groupBy("key").agg(F.min(F.struct("n", "gram")).alias("s"))
    index = names.join(seldom.select("key", F.col("s.gram").alias("gram")), "key")
    for name in as_columns(columns):
        labels = df.select(F.col(name).alias("__label")).distinct().where("__label is not null").withColumn("__text", F.upper("__label"))
        equal = labels.join(known.where("whole"), F.col("__text") == F.col("key")).select("__label", "__order", "__found")
        inside = cut_up(labels, "__text").join(index, "gram").where(F.contains("__text", "key")).select("__label", "__order", "__found")
        found = equal.unionByName(inside).groupBy("__label").agg(F.min_by("__found", "__order").alias("__found"))
        df = (
            df.join(found, df[name] == F.col("__label"), "left")
            .withColumn(name, F.coalesce("__found", name)).drop("__label", "__found")
        )
    return df


def areas_by_name(areas: DataFrame, names: DataFrame | list[str], column: str = "name") -> DataFrame:
    """Areas with one of the given names."""
    if isinstance(names, DataFrame):
        return areas.join(names.select(F.col(names.columns[0]).alias(column)).distinct(), column, "left_semi")
    return areas.where(F.col(column).isin(list(names)))


def border_pairs(areas: DataFrame, borders: list[tuple[str, str]], key: str = "mrid") -> DataFrame:
    """Both ordered pairs of area ids for each pair of country names (case-insensitive)."""
    spark = areas.sparkSession
    both = [(a.lower(), b.lower()) for a, b in borders] + [(b.lower(), a.lower()) for a, b in borders]
    pairs = literal_table(spark, sorted(set(both)), "__from string, __to string")
    left = areas.select(F.lower("name").alias("__from"), F.col(key).alias("out_id"))
    right = areas.select(F.lower("name").alias("__to"), F.col(key).alias("in_id"))
    return pairs.join(left, "__from").join(right, "__to").where("out_id <> in_id").select("out_id", "in_id")
