"""Two-pass external shuffle into shards.

Pass one scatters records by seeded hashes: the id and the number of shards
decide the shard, a second hash of id and text one of the shard's memory-sized
buckets.  Pass two orders each bucket by id, shuffles it by Fisher and Yates with
a generator seeded by shard and bucket, numbers the records and writes them.
A retried task repeats the same order.

Law `key`: shard(n) is the last k below n with hash(id, k) divisible by k + 1.
Adding shard n moves only those ids that the new shard takes, a share of
1 / (n + 1), and each shard has an equal share.

Defined results: a null id counts as one fixed value of its own, so such rows
share a shard (still spread over its buckets); a null text has size 16 and the
checksum of no bytes; repeated rows each keep a slot; equal texts are scattered
independently; texts of any length move whole; an empty table gives an empty table; further columns are written as they are.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headroom.llm.scratch import shared_folder
from headroom.llm.texts import documents

BUCKET_BYTES = 16 << 20
OVERHEAD = 16


def shard_of(key: Column, shards: int, seed: int = 0) -> Column:
    """Shard of an id under the law `key`."""
    draw = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda k: F.when(F.pmod(F.xxhash64(F.lit(seed), key, k), k + 1) == 0, k).otherwise(0))
    return F.array_max(draw)


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def _shuffled(key: str, text: str, seed: int):
    def shuffle(table: pa.Table) -> pa.Table:
        table = table.sort_by([(key, "ascending"), (text, "ascending")])
        shard, bucket = table["__shard"][0].as_py(), table["__bucket"][0].as_py()
        draw = np.random.default_rng([seed, shard, bucket])
        order = list(range(len(table)))
        picks = draw.integers(0, np.arange(1, len(order) + 1)).tolist()
        for i in range(len(order) - 1, 0, -1):  # Fisher and Yates
            j = picks[i]
            order[i], order[j] = order[j], order[i]
        table = table.take(pa.array(order, pa.int64()))
        slot = pa.array(np.arange(len(table)) + table["__before"][0].as_py(), pa.int64())
        return table.drop_columns(["__bucket", "__before"]).append_column("__slot", slot)

    return shuffle


def shuffled(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """`docs` with `__shard` and `__slot` (gapless from 0 in each shard), rows of a bucket together."""
    marked = docs.withColumn("__shard", shard_of(F.col(key), shards, seed))
    total = docs.agg(F.sum(record_size(F.col(text)))).first()[0] or 0
    many = max(1, -(-total // (shards * bucket_bytes)))
    bucket = F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key), F.col(text)), F.lit(many))
    marked = marked.withColumn("__bucket", bucket)
    counts = marked.groupBy("__shard", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    # Records before a bucket in its shard; a row per bucket, so small against the records.
    earlier = Window.partitionBy("__shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("__shard", "__bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    ready = marked.join(before, ["__shard", "__bucket"]).select(*docs.columns, "__shard", "__bucket", "__before")
    schema = ready.drop("__bucket", "__before").schema.add("__slot", "long")
    return ready.groupBy("__shard", "__bucket").applyInArrow(_shuffled(key, text, seed), schema)


def write_shards(docs: DataFrame, path: str, shards: int, **options) -> None:
    """Whole records as Parquet below `path`, a folder per shard, in shuffled order."""
    shuffled(docs, shards, **options).write.partitionBy("__shard").parquet(path)


def op8_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all records into 40 shards and describes what the shards hold."""
    path = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    write_shards(documents(spark, sf_dir), path, 40)
    records = spark.read.parquet(path)
    grown = shard_of(F.col("doc_id"), 41)
    return records.select(
        "doc_id", record_size(F.col("text")).alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        F.col("__shard").cast("int").alias("shard"), F.col("__slot").alias("slot"), grown.cast("int").alias("grown_shard"))


QUERIES = {"op8_external_shuffle": op8_external_shuffle}
ORACLE: dict[str, str] = {}
