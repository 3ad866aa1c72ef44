"""Helpers that keep plans safe at scale: shared scratch tables, lineage cuts, epochs."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's `spark.checkpoint.dir`.

    Only a local session without that setting (tests) gets a folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="headroom-"))
        path = context.getCheckpointDir()
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The result as a table written to the shared folder (one job), read back.

    Later plans start from its files: lost executors only cost their own tasks,
    and the file sizes give Catalyst a true size for its join choices.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(df: DataFrame) -> None:
    """Delete the files of a table made by `cut_lineage`, once nothing lazy reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def as_columns(keys) -> list[str]:
    """One name or several -> list of names."""
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def epoch(column) -> Column:
    """Seconds since 1970 (the session zone is UTC) of either timestamp type."""
    column = F.col(column) if isinstance(column, str) else column
    return F.unix_seconds(column.cast("timestamp"))


def from_epoch(seconds: Column, like: str = "timestamp") -> Column:
    """Inverse of `epoch`, in the timestamp type named by `like`."""
    return F.timestamp_seconds(seconds).cast(like)


def time_literal(value, kind: str = "timestamp") -> Column:
    """A bound as a column of time type `kind`; naive times are UTC whatever the driver's own zone."""
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        value = value.isoformat(" ")
    return F.lit(value).cast(kind)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small parameter table as literals, so that Catalyst knows its size."""
    fields = T._parse_datatype_string(schema).fields

    def cell(value, field) -> Column:
        kind = field.dataType.simpleString()
        column = time_literal(value, kind) if isinstance(value, datetime) else F.lit(value).cast(kind)
        return column.alias(field.name)

    structs = [F.struct(*[cell(v, f) for v, f in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi join on `keys` in which nulls match; key columns come from `left`."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns])
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(F.col(f"__r_{key}"))
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def put_text(spark: SparkSession, path: str, text: str) -> str:
    """Write a small text file (a schema, a setting) where all executors can read it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return path
