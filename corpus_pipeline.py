"""Corpus pipeline: raw documents to sharded training records.

Each stage takes (spark, docs, sf_dir) and all that its predecessor kept; all but
the last return the columns of documents.  `run` writes every stage to the shared
folder before the next reads it, so a lost executor repeats no finished stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.llm import decontaminate, minhash, raking, sharding, toxicity
from headroom.llm.scratch import stored

SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by the compression-distance model, which learns from the labelled documents."""
    model = toxicity.fit(docs, labels=spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, model, score="__score").filter("__score < 0.5").select(docs.columns)


def with_row(docs: DataFrame) -> DataFrame:
    """`docs` with a key of each row, `__row`, stored so that it stays the same; ids may be null or repeated."""
    return stored(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id (null ids last), of each class of rows that are 0.8 alike."""
    rows = with_row(docs)
    classes = minhash.near_duplicates(rows, 80, key="__row").select("__row", "component_id")
    ranked = classes.join(rows.select("__row", "doc_id"), "__row").groupBy("component_id").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "__row")).alias("first"))
    return rows.join(ranked.select(F.col("first.__row").alias("__row")), "__row", "left_semi").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of the benchmark, whatever their ids."""
    return decontaminate.decontaminated(with_row(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key="__row").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, some in several copies, so that their tokens meet the source, language and topic targets.

    The draw is by id; a row without one is drawn by its text, so that such rows don't share one draw.
    """
    drawn = docs.withColumn("__draw", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("?"), F.xxhash64("text").cast("string"))))
    copies = F.explode(F.array_repeat(F.lit(True), F.col("__copies")))
    return raking.mixed(drawn, key="__draw").filter("__copies > 0").withColumn("__copy", copies).select(docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their slot in it."""
    return sharding.shuffled(docs, SHARDS).withColumnsRenamed({"__shard": "shard", "__slot": "slot"})


STAGES = [
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated), ("mixing", mix_sources), ("sharding", shard),
]

#: Classifier, hashing and shuffle have no SQL counterpart; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
