"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over `SPAN` neighbouring tokens; it hashes the tokens at
its set positions and ignores the others, so that a substituted word on an
ignored position costs no hit.  All windows of all test items and of all training
documents are hashed under every mask and joined on the hash.  A hit fixes how
item and document lie to each other; there the tokens are compared outwards from
the hit, substitutions included, and the best stretch is kept if it is long and
alike enough.  Every hit is checked that lies in no stretch kept before, so an item
whose copy is broken several times gives all its stretches.

Training windows first meet a bit filter of fixed size (`FILTER_BITS`, whatever
the size of the benchmark) made from the item hashes; it only spares the join
windows that can't match.  Documents then send only the regions around hits.

Tokens are runs of letters and digits in A-Z lower case, so punctuation and case
don't matter.  Items of 5 to `SPAN` - 1 tokens are sought whole; shorter ones are
no evidence and ignored.

Defined results: null and empty texts overlap with nothing; rows whose id is null
are compared like others (and reported with a null id); repeated rows are reported
once; an empty documents or benchmark table gives no rows; extra columns are ignored;
texts of any length are read whole, one slice of texts at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.llm.scratch import stored
from headroom.llm.texts import NO_LETTER, U, documents, flat, mix, slices, words

SPAN = 10
MASKS = ("1110110101", "1101011011", "1011101110", "1111010011")  # 7 of 10 tokens count
SHORTEST = 5
FILTER_BITS = 27
REACH = 40  # tokens shown on both sides of a hit
MIN_TOKENS = 10
MIN_ALIKE = 0.75
MISMATCH, DROP = 2, 8  # a mismatch takes so much from the score; the search ends so far below the best


def numbered(short: list[int]) -> list[tuple[int, str]]:
    """All masks and the whole shapes of the short items, each with the number that tells its keys apart."""
    return [*enumerate(MASKS), *((SPAN * 10 + n, "1" * n) for n in short)]


def seeds(tokens: np.ndarray, first: np.ndarray, shapes: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, position, key) of every window of every shape within a text."""
    counts = np.diff(first)
    texts, places, keys = [], [], []
    for number, shape in shapes:
        n = len(tokens) - len(shape) + 1
        if n <= 0:
            continue
        key = np.full(n, number + 1, np.uint64)
        for at, used in enumerate(shape):
            if used == "1":
                key = (key ^ tokens[at : n + at]) * U(0x9FB21C651E98DF25)
                key ^= key >> U(29)
        text = np.repeat(np.arange(len(counts)), counts)[:n]
        inside = np.flatnonzero(np.arange(n) + len(shape) <= first[text + 1])
        texts.append(text[inside])
        places.append(inside - first[text[inside]])
        keys.append(mix(key[inside]))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in (texts, places, keys))


def _item_tokens(batches):
    for batch in batches:
        data, offsets = flat(batch.column(1))
        tokens, first = words(data, offsets, NO_LETTER)
        lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(tokens.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["item", "item_tokens"])


def _item_seeds(batches, short: list[int]):
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for item, tokens in zip(ids, batch.column(1).to_pylist()):
            tokens = np.array(tokens, np.int64).view(np.uint64)
            n = len(tokens)
            shapes = numbered([]) if n >= SPAN else [x for x in numbered(short) if len(x[1]) == n < SPAN]
            _, at, key = seeds(tokens, np.array([0, n]), shapes)
            yield pa.RecordBatch.from_arrays([pa.array([item] * len(key), pa.int64()), pa.array(at), pa.array(key.view(np.int64))], names=["item", "item_at", "key"])


REGION = "doc long, start long, tokens array<long>, places array<long>, keys array<long>"


def _regions(batches, shapes, bits):
    table = np.frombuffer(bits.value, np.uint8)
    for batch in batches:
        data, offsets = flat(batch.column(1))
        ids = batch.column(0).to_pylist()
        for low, high in slices(offsets):
            part = offsets[low : high + 1]
            tokens, first = words(data[part[0] : part[-1]], part - part[0], NO_LETTER)
            text, place, key = seeds(tokens, first, shapes)
            slot = (key >> U(64 - FILTER_BITS)).astype(np.int64)
            hit = np.flatnonzero((table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
            if not len(hit):
                continue
            order = hit[np.lexsort((place[hit], text[hit]))]
            text, place, key = text[order], place[order], key[order]
            cut = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (np.diff(place) > REACH))))
            rows = []
            for a, b in zip(cut, [*cut[1:], len(place)]):
                t = text[a]
                begin = max(place[a] - REACH, 0)
                end = min(place[b - 1] + SPAN + REACH, first[t + 1] - first[t])
                rows.append((ids[low + t], int(begin), tokens[first[t] + begin : first[t] + end].view(np.int64), place[a:b] - begin, key[a:b].view(np.int64)))
            types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=["doc", "start", "tokens", "places", "keys"])


def stretch(same: np.ndarray, hit: int) -> tuple[int, int]:
    """[begin, end) of the best stretch around `hit`: matches count 1, mismatches -`MISMATCH`, until `DROP` below the best."""

    def reach(part: np.ndarray) -> int:
        score = np.cumsum(np.where(part, 1, -MISMATCH))
        fallen = np.flatnonzero(np.maximum.accumulate(np.concatenate(([0], score)))[1:] - score > DROP)
        score = score[: fallen[0]] if len(fallen) else score
        return int(np.argmax(score)) + 1 if len(score) and score.max() > 0 else 0

    return hit - reach(same[:hit][::-1]), hit + reach(same[hit:])


def _verified(batches):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    for batch in batches:
        rows = []
        for doc, start, item, places, shift, tokens, other in zip(*(batch.column(k).to_pylist() for k in range(7))):
            a, b = np.array(tokens, np.int64), np.array(other, np.int64)
            low, high = max(shift, 0), min(shift + len(b), len(a))  # the item's first token lies at `shift` in the region
            same = a[low:high] == b[low - shift : high - shift]
            done = 0  # end of the last verified stretch; a later hit before it has its own stretch inside that one
            for place in sorted(places):
                if place - low < done:
                    continue
                begin, end = stretch(same, place - low)
                matched = int(same[begin:end].sum())
                if end - begin >= min(MIN_TOKENS, len(b)) and matched >= MIN_ALIKE * (end - begin):
                    rows.append((doc, item, start + low + begin, low + begin - shift, end - begin, matched))
                    done = end
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["doc", "item", "doc_start", "item_start", "tokens", "matched"])


def _filter_bits(spark: SparkSession, keys: DataFrame):
    """The broadcast bit filter: 2 ** FILTER_BITS bits, so that size is its bound."""
    slot = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    whole = keys.select(F.shiftright(slot, 3).alias("byte"), F.pow(F.lit(2), slot % 8).cast("int").alias("bit")).groupBy("byte").agg(F.bit_or("bit").alias("bits"))
    found = whole.toArrow()
    table = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    table[found["byte"].to_numpy()] = found["bits"].to_numpy().astype(np.uint8)
    return spark.sparkContext.broadcast(table.tobytes())


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc, item, doc_start, item_start, tokens, matched: verified overlaps in token positions, the longest per start pair."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).cast("long"), F.col(item_text).cast("string")).mapInArrow(_item_tokens, "item long, item_tokens array<long>")
    items = stored(items.withColumn("item_no", F.monotonically_increasing_id()), "items")
    lengths = items.select(F.size("item_tokens").alias("n")).filter(F.col("n").between(SHORTEST, SPAN - 1)).distinct()
    short = sorted(r.n for r in lengths.collect())  # SPAN - SHORTEST values at most
    keys = stored(items.select("item_no", "item_tokens").mapInArrow(lambda it: _item_seeds(it, short), "item long, item_at long, key long"), "seeds")
    bits = _filter_bits(spark, keys)
    shapes = numbered(short)
    own = docs.select(F.col(key).cast("long"), F.col(text).cast("string"))
    regions = own.mapInArrow(lambda it: _regions(it, shapes, bits), REGION).withColumn("region", F.monotonically_increasing_id())
    regions = stored(regions, "regions")
    hits = regions.select("region", F.explode(F.arrays_zip("places", "keys")).alias("hit")).select("region", F.col("hit.places").alias("place"), F.col("hit.keys").alias("key"))
    joined = hits.join(keys.withColumnRenamed("item", "item_no"), "key")
    lies = joined.groupBy("region", "item_no", (F.col("place") - F.col("item_at")).alias("shift")).agg(F.collect_set("place").alias("places"))  # at most as many as the item has tokens
    placed = lies.join(regions.select("region", "doc", "start", "tokens"), "region").join(items, "item_no")
    found = placed.select("doc", "start", "item", "places", "shift", "tokens", "item_tokens").mapInArrow(
        _verified, "doc long, item long, doc_start long, item_start long, tokens long, matched long")
    return found.distinct()


def decontaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that overlap with no item; rows with a null id stay. Columns as they are."""
    hit = overlaps(docs, benchmark, key, text).select(F.col("doc").alias("__hit")).filter("__hit is not null").distinct()
    return docs.join(hit, docs[key].cast("long") == hit["__hit"], "left_anti")


def op1_spaced_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "doc_start", "item_start", "tokens", "matched")


QUERIES = {"op1_spaced_seed": op1_spaced_seed}
ORACLE: dict[str, str] = {}
