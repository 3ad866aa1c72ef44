"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; only a local session without it gets a folder of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    held = spark.sparkContext.getCheckpointDir()
    if held is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        held = tempfile.mkdtemp(prefix="headroom-llm-")
        spark.sparkContext.setCheckpointDir(held)
    return held.rstrip("/")


def stored(df: DataFrame, label: str = "table", **options: str) -> DataFrame:
    """`df` as a table written once to the shared folder and read back: lost executors repeat no finished work."""
    return written(df, f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}", **options)


def written(df: DataFrame, path: str, **options: str) -> DataFrame:
    """`df` written to `path` in place of what was there, with options of the writer, and read back."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")  # the table replaces the shuffle files that led to it
    try:
        df.write.mode("overwrite").options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table made by `stored` once nothing lazy reads it any more."""
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
