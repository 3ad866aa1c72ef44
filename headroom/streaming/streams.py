"""Structured Streaming: message intake, keyed upserts, exceedance checks.

Messages are rows (headers map<string,string>, payload string, received
timestamp).  Sinks are `foreachBatch` upserts, which give the same store when a
batch runs again after a failure.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from headroom.operators.exceedance import join_realised_proposed, next_version, split_by_receiver
from headroom.operators.merge import update_by_key
from headroom.scale import as_columns, join_null_safe
from headroom.sources.store import DELETED, read_store, store_exists, upsert_by_key

MESSAGE_SCHEMA = "headers map<string,string>, payload string, received timestamp"


def message_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = MESSAGE_SCHEMA, files_per_batch: int | None = None) -> DataFrame:
    """Messages that arrive as files."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def with_headers(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Messages that carry all the given headers."""
    for name, value in headers.items():
        df = df.where(F.try_element_at("headers", F.lit(name)) == value)
    return df


def payload_kind(payload: Column) -> Column:
    """`xml`, `json` or null, by the first character that is not blank."""
    first = F.substring(F.ltrim(payload), 1, 1)
    return F.when(first == "<", "xml").when(first.isin("{", "["), "json")


def parse_payloads(df: DataFrame, parsers: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Rows of all payloads, each kind through its parser (DataFrame of messages -> DataFrame of points)."""
    from headroom.operators.merge import union_all

    kinds = df.withColumn("__kind", payload_kind(F.col("payload")))
    return union_all([parse(kinds.where(F.col("__kind") == kind).drop("__kind")) for kind, parse in parsers.items()])


def stream_points(
    stream: DataFrame, headers: dict[str, str], target: str, parsers: dict[str, Callable[[DataFrame], DataFrame]], id_fields,
    order, time: str = "valid_from",
) -> DataStreamWriter:
    """Filter messages by header, parse them by payload kind and upsert the points into the store."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        upsert_by_key(parse_payloads(batch, parsers), target, id_fields, order, time, label=f"stream-{batch_id}")

    return with_headers(stream, headers).writeStream.foreachBatch(handle)


def stream_latest_by_key(stream: DataFrame, keys, target: str, order, time: str = "valid_from") -> DataStreamWriter:
    """Repeated deliveries of one key: the last one wins in the store."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        upsert_by_key(batch, target, as_columns(keys), order, time, label=f"stream-{batch_id}")

    return stream.writeStream.foreachBatch(handle)


def first_by_key(stream: DataFrame, keys, time: str, delay: str = "1 day") -> DataFrame:
    """First delivery of each key, with state kept for `delay` only (naive times are read as UTC)."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return timed.dropDuplicatesWithinWatermark(as_columns(keys))


def stream_exceeded_check(
    stream: DataFrame, proposed: DataFrame, stored: str, result: str, receivers: DataFrame, keys, operator: str = "CASCADE",
    level: str = "level", sender: str = "sender", received: str = "received", time: str = "valid_from", **options,
) -> DataStreamWriter:
    """Every realised batch: append to the store, compare with the proposed values, emit per receiver.

    A product is `keys` and its validity `time`.  Of the products a batch touches, all exceedances are worked out
    anew and written to `result` by product, level and receiver; one that is no longer there is taken out by a
    tombstone.  Version numbers follow the stored ones.  `proposed` may have `time` or hold for all times.
    """
    from headroom.registry import EXCEEDANCE

    products = [*as_columns(keys), time]
    ids = [*products, level, sender]
    out_ids = [*products, level, "receiver"]

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, label = batch.sparkSession, f"stream-{batch_id}"
        if store_exists(spark, stored):  # without this batch's own rows, should it run again
            numbered = next_version(batch, ids, read_store(spark, stored, without=label))
        else:
            numbered = batch.withColumn("version_number", F.lit(1))
        upsert_by_key(numbered, stored, ids, [received], time, label=label)
        touched = batch.select(*products).distinct()
        realised = join_null_safe(read_store(spark, stored).drop("id_key"), touched, products, "left_semi")
        asked = join_null_safe(proposed, touched, products, "left_semi") if time in proposed.columns else join_null_safe(proposed, touched, as_columns(keys))
        joined = join_realised_proposed(asked, realised, products, level, sender, received)
        exceeded = EXCEEDANCE[operator](joined, by=products, level=level, **options)
        stamped = exceeded.withColumnRenamed(sender, "receiver").withColumn("batch", F.lit(batch_id))
        out = split_by_receiver(stamped, receivers, [*products, level], ["batch"]).withColumn(DELETED, F.lit(False))
        if store_exists(spark, result):
            before = join_null_safe(read_store(spark, result, without=label).drop("id_key"), touched, products, "left_semi")
            cleared = join_null_safe(before, out.select(*out_ids), out_ids, "left_anti")
            out = out.unionByName(cleared.withColumns({"batch": F.lit(batch_id), DELETED: F.lit(True)}), allowMissingColumns=True)
        upsert_by_key(out, result, out_ids, ["batch"], time, label=label)

    return stream.writeStream.foreachBatch(handle)


def merge_realised(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Stored realised rows updated by a batch, field by field."""
    return update_by_key(old, new, keys)


def drain_available(writer: DataStreamWriter, checkpoint: str, timeout: int | None = None) -> StreamingQuery:
    """Process all that is queued, then stop; a query that is not done within `timeout` seconds is stopped and raises."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if query.awaitTermination(timeout) is False:
        query.stop()
        raise TimeoutError(f"the queued data was not processed within {timeout} s")
    return query


def route(handlers: list[tuple[dict[str, str], Callable[[DataFrame, int], None]]]) -> Callable[[DataFrame, int], None]:
    """One `foreachBatch` function for several (headers, handler) pairs."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        for headers, handler in handlers:
            handler(with_headers(batch, headers), batch_id)

    return handle
