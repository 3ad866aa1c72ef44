"""Session defaults used by the tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None, **options) -> SparkSession:
    """Session in UTC with adaptive execution; a cluster keeps its own sizes."""
    builder = SparkSession.builder.appName("headroom")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(options)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
