"""Near-duplicates by circulant MinHash, banding and exact Jaccard.

Two permutations make all coordinates: sigma scatters a shingle over the 2**32
places of a circle, pi orders the places, and coordinate k reads pi shifted by
k places: h_k(S) = min over s of pi(sigma(s) + k).  Bands of five coordinates
are bucket keys.  Their number follows from the similarity sought, so that a pair
at exactly that similarity is missed with a chance below `MISS`.

Every link is confirmed on the full shingle sets:
  1. Equal sets collapse to their smallest id, however many copies there are.
  2. Each member of a bucket is compared with the bucket's head, the member that
     shares buckets with most others; those still apart get a second head.
  3. Documents of buckets that still hold several components are ordered by their
     rarest shingles.  A linked pair shares one among the first
     n - 0.85 n + 1, with enough shingles left behind it in both (prefix and
     position bounds); only such pairs are compared.
No step lists the pairs of a bucket, and pairs left out are in one component
already or can't be linked, so components are exact for all pairs that share a bucket.

Defined results: null or wordless texts have no shingles and stand alone; a row
whose id is null is linked with nothing and kept; rows of one id share a class;
an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headroom.llm.scratch import drop_stored, stored
from headroom.llm.texts import U, documents, flat, mix, per_text, shingles, slices, words

MISS = 1e-7
ROWS = 5
HEADS = 2


def bands_for(percent: int) -> int:
    """Bands of `ROWS` coordinates that miss a pair at the threshold with a chance below `MISS`."""
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** ROWS)))


def signatures(hashes: np.ndarray, offsets: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of each text (a row per text) from its shingle hashes."""
    places = (mix(hashes ^ U(0x51A7E)) >> U(32)).astype(np.uint32)  # sigma
    out = np.zeros((len(offsets) - 1, coordinates), np.uint32)
    x, y = np.empty_like(places), np.empty_like(places)
    for k in range(coordinates):
        np.add(places, np.uint32(k), out=x)  # the circular shift
        np.right_shift(x, 16, out=y)
        np.bitwise_xor(x, y, out=x)  # pi
        np.multiply(x, np.uint32(0x7FEB352D), out=x)
        np.right_shift(x, 15, out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint32(0x846CA68B), out=x)
        np.right_shift(x, 16, out=y)
        np.bitwise_xor(x, y, out=x)
        out[:, k] = per_text(np.minimum, x, offsets, 0)
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    keys = np.zeros((len(signature), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, np.uint64)
        for k in range(ROWS):
            key = mix(key * U(0x9FB21C651E98DF25) + signature[:, band * ROWS + k].astype(np.uint64))
        keys[:, band] = key
    return keys


def _sets(column, length: int):
    """Per slice of texts: sorted distinct shingles, their offsets."""
    data, offsets = flat(column)
    for low, high in slices(offsets):
        part = offsets[low : high + 1]
        hashes, first = words(data[part[0] : part[-1]], part - part[0])
        hashes, places = shingles(hashes, first, length)
        kept = [np.unique(hashes[a:b]) for a, b in zip(places[:-1], places[1:])]
        sizes = np.array([len(x) for x in kept])
        yield np.concatenate(kept) if kept else hashes[:0], np.concatenate(([0], np.cumsum(sizes)))


def _sign(batches, length: int, bands: int):
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("bands", pa.list_(pa.int64()))])
    for batch in batches:
        ids, done = batch.column(0), 0
        for hashes, offsets in _sets(batch.column(1), length):
            n = len(offsets) - 1
            keys = band_keys(signatures(hashes, offsets, bands * ROWS), bands).view(np.int64)
            sums = [per_text(np.add, mix(hashes ^ U(salt)), offsets, 0).view(np.int64) for salt in (0x1D, 0x9E37)]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([ids.slice(done, n), pa.array(np.diff(offsets)), pa.array(sums[0]), pa.array(sums[1]), lists], schema=schema)
            done += n


def _pack(batches, length: int):
    for batch in batches:
        ids, done = batch.column(0), 0
        for hashes, offsets in _sets(batch.column(1), length):
            n = len(offsets) - 1
            packed = [hashes[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([ids.slice(done, n), pa.array(packed, pa.binary())], names=["doc", "shingles"])
            done += n


def _shared(batches):
    """Sizes of intersection and union of two packed sets."""
    for batch in batches:
        both = []
        for a, b in zip(batch.column(2), batch.column(3)):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
            if len(a) > len(b):
                a, b = b, a
            at = np.searchsorted(b, a)
            at[at == len(b)] = 0
            same = int((b[at] == a).sum()) if len(b) else 0
            both.append((same, len(a) + len(b) - same))
        same, union = (pa.array([x[k] for x in both], pa.int64()) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), same, union], names=["low", "high", "same", "union"])


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (low, high) -> with the sizes of intersection and union."""
    low = sets.select(F.col("doc").alias("low"), F.col("shingles").alias("low_set"))
    high = sets.select(F.col("doc").alias("high"), F.col("shingles").alias("high_set"))
    return pairs.join(high, "high").join(low, "low").select("low", "high", "low_set", "high_set").mapInArrow(
        _shared, "low long, high long, same long, union long")


def components(edges: DataFrame) -> DataFrame:
    """Edges (low, high) -> (doc, component): the smallest node reachable, by min-label spreading with pointer jumps."""
    both = stored(edges.select(F.col("low").alias("doc"), F.col("high").alias("to")).union(edges.select("high", "low")).distinct(), "edges")
    labels = stored(both.groupBy("doc").agg(F.min("to").alias("m")).select("doc", F.least("doc", "m").alias("label")), "labels")
    while True:
        heard = both.join(labels.select(F.col("doc").alias("to"), F.col("label").alias("heard")), "to").groupBy("doc").agg(F.min("heard").alias("heard"))
        lowest = labels.join(heard, "doc").select("doc", "label", F.least("label", "heard").alias("next"))
        jump = labels.select(F.col("doc").alias("next"), F.col("label").alias("jump"))
        following = stored(lowest.join(jump, "next", "left").select("doc", "label", F.coalesce(F.least("next", "jump"), "next").alias("new")), "labels")
        changed = following.filter("label <> new").limit(1).count()
        drop_stored(labels)
        labels = following.select("doc", F.col("new").alias("label"))
        if not changed:
            drop_stored(both)
            return labels.withColumnRenamed("label", "component")


def _crowded(members: DataFrame) -> DataFrame:
    """Buckets of at least two documents, with their size."""
    return members.groupBy("bucket").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")


def _headed(members: DataFrame) -> DataFrame:
    """(bucket, doc) -> with the bucket's head: the document that meets most others over all its buckets, then the smallest."""
    met = members.join(_crowded(members), "bucket")
    central = met.groupBy("doc").agg(F.sum("many").alias("meets"))
    ranked = members.join(central, "doc").select("bucket", F.struct("meets", (-F.col("doc")).alias("minus")).alias("rank"))
    heads = ranked.groupBy("bucket").agg(F.max("rank").alias("rank")).select("bucket", (-F.col("rank.minus")).alias("head"))
    return members.join(heads, "bucket").select("bucket", "head", "doc")


def _unpack(batches):
    for batch in batches:
        for doc, component, packed in zip(batch.column(0), batch.column(1), batch.column(2)):
            values = np.frombuffer(packed.as_buffer(), np.int64)
            n = len(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, x.as_py(), np.int64)) for x in (doc, component)] + [pa.array(values)], names=["doc", "component", "shingle"])


def _by_rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (low, high) of different components that may reach the similarity, by prefix and position bounds."""
    single = sets.select("doc", "component", "shingles").mapInArrow(_unpack, "doc long, component long, shingle long")
    single = stored(single, "single")
    ranked = single.join(single.groupBy("shingle").agg(F.count(F.lit(1)).alias("many")), "shingle")
    order = Window.partitionBy("doc").orderBy("many", "shingle")
    placed = ranked.withColumn("at", F.row_number().over(order)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("doc")))
    prefix = stored(placed.filter((F.col("many") > 1) & ((F.col("at") - 1) * 100 <= F.col("n") * (100 - percent))).select("shingle", "doc", "component", "n", (F.col("n") - F.col("at") + 1).alias("left")), "prefix")
    one, two = prefix.alias("one"), prefix.alias("two")
    enough = F.least("one.left", "two.left") * (100 + percent) >= (F.col("one.n") + F.col("two.n")) * percent
    met = one.join(two, (F.col("one.shingle") == F.col("two.shingle")) & (F.col("one.doc") < F.col("two.doc")) & (F.col("one.component") != F.col("two.component")) & enough)
    return met.select(F.col("one.doc").alias("low"), F.col("two.doc").alias("high")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 85, length: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: classes of documents linked by Jaccard of at least `percent` hundredths."""
    bands = bands_for(percent)
    own = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    signed = stored(own.mapInArrow(lambda it: _sign(it, length, bands), "doc long, n long, a long, b long, bands array<long>"), "signed")
    usable = signed.filter("doc is not null and n > 0")

    # 1. Equal sets: the smallest id stands for all.
    equal = stored(usable.groupBy("a", "b", "n").agg(F.min("doc").alias("first")), "equal")
    first = usable.join(equal.select(F.col("first").alias("doc"), "a", "b", "n"), ["doc", "a", "b", "n"], "left_semi").dropDuplicates(["doc", "a", "b"])

    # 2. Buckets of at least two different sets; members against heads.
    bucketed = first.select("doc", F.explode("bands").alias("bucket"))
    members = stored(bucketed.join(_crowded(bucketed), "bucket").select("bucket", "doc"), "members")
    wanted = members.select("doc").distinct()
    sets = stored(own.filter("doc is not null").join(wanted, "doc", "left_semi").mapInArrow(lambda it: _pack(it, length), "doc long, shingles binary"), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        compared = stored(_compared(pairs, sets), "pairs")
        return compared.filter(F.col("same") * 100 >= F.col("union") * percent).select("low", "high")

    edges, active = [], members
    for _ in range(HEADS):
        headed = stored(_headed(active), "headed")
        pairs = headed.filter("head <> doc").select(F.least("head", "doc").alias("low"), F.greatest("head", "doc").alias("high")).distinct()
        edges.append(linked(pairs))
        found = components(reduce(DataFrame.union, edges))
        heads = found.select(F.col("doc").alias("head"), F.col("component").alias("main"))
        placed = headed.join(found, "doc", "left").join(heads, "head", "left").filter(F.coalesce("component", "doc") != F.coalesce("main", "head"))
        apart = placed.select("bucket", "doc")
        active = stored(apart.join(_crowded(apart), "bucket", "left_semi"), "apart")

    # 3. Documents of buckets that still hold several components, by their rarest shingles.
    placed = members.join(found, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("bucket")
    unsure = placed.join(mixed, "bucket", "left_semi").select("doc", "component").distinct()
    edges.append(linked(_by_rare_shingles(sets.join(unsure, "doc"), percent)))
    copies = usable.join(equal, ["a", "b", "n"]).filter("first <> doc").select(F.col("first").alias("low"), F.col("doc").alias("high"))
    edges = reduce(DataFrame.union, edges).union(copies)

    final = components(edges).withColumnRenamed("doc", "node")
    result = signed.join(final, signed["doc"] == final["node"], "left")
    result = result.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` but those that a smaller id stands for; columns as they are."""
    gone = near_duplicates(docs, percent, key=key, text=text).filter("not kept").select(F.col(key).alias("__gone")).distinct()
    return docs.join(gone, docs[key].cast("long") == gone["__gone"], "left_anti")


def op10_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), 85)


QUERIES = {"op10_circulant_minhash": op10_circulant_minhash}
ORACLE: dict[str, str] = {}
