"""JSON payloads: matrix tables and lists of points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.operators.columns import DIRECTIONS, classify_id_tokens, decode
from headroom.functions.times import parse_datetime_any

MATRIX_SCHEMA = (
    "data struct<id:string,measurement_unit:string,"
    "columns:array<struct<index:int,group_level_0:string,group_level_1:string,label:string>>,"
    "timeseries:array<struct<`from`:string,`to`:string,values:array<double>>>>"
)
# Direction words of published tables.
DIRECTION_WORDS = {"Upward": "UP", "Downward": "DOWN", "Symetric": "UP_AND_DOWN"}


def read_matrix_json(df: DataFrame, payload: str = "value", areas: dict[str, str] | None = None, classify: bool = True) -> DataFrame:
    """Payloads `{data:{id, columns:[…], timeseries:[{from,to,values[]}]}}` -> one row per header and time.

    `areas` maps area names to ids.  With `classify` the table id gives message,
    business and process type; a process type missing there comes from the
    column group.
    """
    data = F.from_json(F.col(payload), MATRIX_SCHEMA).getField("data")
    rows = (
        df.select(data.alias("d"))
        .select("d.id", "d.measurement_unit", "d.columns", F.explode("d.timeseries").alias("t"))
        .select("id", "measurement_unit", "t", F.explode("columns").alias("c"))
    )
    word = F.coalesce(*[F.when(F.col("c.label") == w, F.lit(d)) for w, d in DIRECTION_WORDS.items()], F.col("c.label"))
    result = rows.select(
        F.col("id").alias("mrid"), F.col("measurement_unit"),
        parse_datetime_any(F.col("t.from")).alias("valid_from"), parse_datetime_any(F.col("t.to")).alias("valid_to"),
        F.col("c.group_level_0").alias("domain_name"), F.col("c.group_level_1").alias("type_name"), word.alias("direction_name"),
        F.try_element_at(F.col("t.values"), F.col("c.index") + 1).alias("quantity"), F.lit(1).alias("position"),
    ).withColumn("direction_code", decode(F.col("direction_name"), DIRECTIONS, "code"))
    if areas:
        names = F.create_map(*[F.lit(x) for pair in areas.items() for x in pair])
        result = result.withColumn("domain", F.try_element_at(names, F.col("domain_name")))
    if classify:
        result = classify_id_tokens(result, "mrid")
        from_type = classify_id_tokens(result.select("*"), "type_name", None, " ")
        result = from_type.withColumnsRenamed({"process_type": "__type"}).drop("message_type", "business_type", "market_product_type")
        result = classify_id_tokens(result, "mrid").withColumn("process_type", F.coalesce("process_type", "__type")).drop("__type")
    return result


def read_json_points(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Files that hold a JSON list of points -> one row per point, nested fields kept."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def parse_json_points(df: DataFrame, payload: str, schema: str) -> DataFrame:
    """JSON lists held in a column (e.g. messages) -> one row per point of struct `schema`."""
    points = F.explode(F.from_json(F.col(payload), f"array<struct<{schema}>>"))
    return df.select(*[c for c in df.columns if c != payload], points.alias("__point")).select("*", "__point.*").drop("__point")
