"""SpotSigs fingerprints: chains of content words that follow common words.

Every common word (and the start of the text) is an anchor; it and the next
`CHAIN` words that are not common make one signature.  The fingerprint is the
sorted set of 32-bit signatures in hex, the likeness of two fingerprints their
Jaccard similarity.  Navigation, numbers and other matter without common words
hardly counts.

`similar_pairs` joins whole tables: equal fingerprints collapse to one, sets meet
only in neighbouring length partitions and over their rarest signatures, and the
comparison is pruned by length and position bounds before the sets are compared.

Words are runs of letters and digits in A-Z lower case.  Common words come from a
fixed list of four languages, so that a document's fingerprint needs no corpus.

Defined results: null is the empty text; an empty text has the empty fingerprint,
two of those have likeness 1; a text without words has one signature of its bytes;
rows of one id are ordered by text, rows with a null id come last; extra columns
are ignored; texts of any length are read whole; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headroom.llm.scratch import stored
from headroom.llm.texts import NO_LETTER, U, documents, flat, mix, partitions, slices, words

CHAIN = 3

# Common words.
COMMON = """a an and are as at be by for from in is it of on or that the this to was with
das dem den der des die ein eine für im ist mit nicht sie und von zu
al como con de del el en es la las los no para por que se su un una y
au aux ce dans des du elle est et il la le les ne pas pour qui sur une""".split()


def _common() -> np.ndarray:
    text = pa.array(sorted(set(COMMON)))
    return np.sort(words(*flat(text), NO_LETTER)[0])


def signatures(column) -> list[np.ndarray]:
    """Sorted distinct 32-bit signatures of each text of an Arrow column."""
    data, offsets = flat(column)
    common, out = _common(), []
    for low, high in slices(offsets):
        part = offsets[low : high + 1]
        own = data[part[0] : part[-1]]
        token, first = words(own, part - part[0], NO_LETTER)
        n = len(first) - 1
        at = np.searchsorted(common, token)
        at[at == len(common)] = 0
        anchor = common[at] == token if len(token) else np.zeros(0, bool)
        content = token[~anchor]
        before = np.concatenate(([0], np.cumsum(~anchor)))  # content words before each token
        stop = before[first[1:]]
        text = np.repeat(np.arange(n), np.diff(first))
        place = np.flatnonzero(anchor)
        full = np.flatnonzero(np.diff(first) > 0)
        # Anchors: the start of each text with words, then every common word.
        head = np.concatenate((np.full(len(full), 0xA11CE, np.uint64), token[place]))
        begin = np.concatenate((before[first[:-1][full]], before[place + 1]))
        owner = np.concatenate((full, text[place]))
        key = mix(head)
        for k in range(CHAIN):
            spot = begin + k
            inside = spot < stop[owner]
            link = np.zeros(len(key), np.uint64)
            link[inside] = content[spot[inside]]
            key = mix(key * U(0x9E3779B97F4A7C15) + link)
        small = (key >> U(32)).astype(np.uint32)
        order = np.lexsort((small, owner))
        small, owner = small[order], owner[order]
        cuts = np.searchsorted(owner, np.arange(n + 1))
        for i in range(n):
            found = np.unique(small[cuts[i] : cuts[i + 1]])
            if not len(found) and part[i + 1] > part[i]:
                digest = hashlib.sha256(data[part[i] : part[i + 1]].tobytes()).digest()
                found = np.frombuffer(digest[:4], ">u4").astype(np.uint32)
            out.append(found)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) and not len(b):
        return 1.0
    same = len(np.intersect1d(a, b, assume_unique=True))
    return same / (len(a) + len(b) - same)


def printed(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def add(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([printed(s) for s in signatures(batch.column(1))], pa.string())], names=[key, "fingerprint"])

    return docs.select(key, F.col(text).cast("string").alias(text)).mapInArrow(add, f"`{key}` {kind}, fingerprint string")


def similar_pairs(prints: DataFrame, threshold: float = 0.8, key: str = "doc_id") -> DataFrame:
    """(low, high, likeness) between the smallest ids of different fingerprints that are alike; null ids and empty fingerprints are left out."""
    classes = prints.filter(F.col(key).isNotNull() & (F.col("fingerprint") != "")).groupBy("fingerprint").agg(F.min(key).alias("doc"))
    part = F.transform(F.sequence(F.lit(0), F.length("fingerprint") - 8, F.lit(8)), lambda i: F.conv(F.col("fingerprint").substr(i + 1, F.lit(8)), 16, 10).cast("long"))
    sets = classes.select("doc", part.alias("spots")).withColumn("n", F.size("spots"))
    sets = stored(sets.withColumn("partition", F.floor(F.log("n") / -math.log(threshold)).cast("int")), "spots")
    single = sets.select("doc", "n", "partition", F.explode("spots").alias("spot"))
    rare = single.groupBy("spot").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    order = Window.partitionBy("doc").orderBy("many", "spot")
    # A signature of one document alone can't be shared, but comes before all others.
    ranked = single.join(rare, "spot").withColumn("at", F.row_number().over(order))
    shared = ranked.groupBy("doc").agg(F.count(F.lit(1)).alias("m"))
    ranked = ranked.join(shared, "doc").withColumn("at", F.col("at") + F.col("n") - F.col("m"))
    prefix = ranked.filter(F.col("at") - 1 <= F.col("n") * (1 - threshold) + 1e-9).withColumn("left", F.col("n") - F.col("at") + 1)
    prefix = stored(prefix.select("spot", "doc", "n", "partition", "left"), "prefix")
    one, two = prefix.withColumn("meets", F.explode(F.array("partition", F.col("partition") + 1))).alias("one"), prefix.alias("two")
    smaller = (F.col("one.n") < F.col("two.n")) | ((F.col("one.n") == F.col("two.n")) & (F.col("one.doc") < F.col("two.doc")))
    enough = F.least("one.left", "two.left") * (1 + threshold) >= (F.col("one.n") + F.col("two.n")) * threshold - 1e-9
    met = one.join(two, (F.col("one.spot") == F.col("two.spot")) & (F.col("one.meets") == F.col("two.partition")) & smaller & enough & (F.col("one.n") >= F.col("two.n") * threshold - 1e-9))
    pairs = met.select(F.least("one.doc", "two.doc").alias("low"), F.greatest("one.doc", "two.doc").alias("high")).distinct()
    a, b = (sets.select(F.col("doc").alias(x), F.col("spots").alias(f"{x}_spots")) for x in ("low", "high"))
    both = pairs.join(a, "low").join(b, "high").withColumn("same", F.size(F.array_intersect("low_spots", "high_spots")))
    alike = F.col("same") / (F.size("low_spots") + F.size("high_spots") - F.col("same"))
    return both.select("low", "high", alike.alias("likeness")).filter(F.col("likeness") >= threshold - 1e-12)


FOLLOWED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _followed(batches):
    """Rows ordered by bucket and place; each is compared with the one behind it, the last of a bucket being a guest."""
    pending = None
    for batch in batches:
        rows = list(zip(*(batch.column(k).to_pylist() for k in range(3))))  # guest, id, text
        rows = ([pending] if pending else []) + rows
        for a in range(0, len(rows) - 1, 256):
            part = rows[a : a + 257]
            texts = [r[2] for r in part]
            edited = []
            for text, behind in zip(texts, texts[1:]):
                half = len(text) // 2
                edited.append(text[: len(text) - half] + behind[:half])
            own, changed = signatures(pa.array(texts, pa.string())), signatures(pa.array(edited, pa.string()))
            out = [
                (part[i][1], len(texts[i]), hashlib.sha256(edited[i].encode()).hexdigest(), printed(own[i]), printed(changed[i]), likeness(own[i], changed[i]), likeness(own[i], own[i + 1]))
                for i in range(len(part) - 1) if not part[i][0]]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
        pending = rows[-1] if rows else None


def compared_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its text's fingerprint, that of its edited text and the likeness to this and to the next row's.

    The rows are cut into ranges of ids; the first row of each range is also sent,
    as a guest, behind the last row of the range above, so texts move once.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    many = partitions(spark)
    cuts = own.select(F.percentile_approx("id", [i / many for i in range(1, many)] or [0.5], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    bucket = F.coalesce(F.size(F.filter(F.lit(cuts).cast("array<long>"), lambda c: c <= F.col("id"))), F.lit(-1)) if cuts else F.lit(0)
    placed = own.withColumn("bucket", F.when(F.col("id").isNull(), -1).otherwise(bucket))
    heads = placed.groupBy("bucket").agg(F.max("id").alias("head")).collect()  # a row per range
    if not heads:
        return spark.createDataFrame([], FOLLOWED)
    order = sorted((h.bucket for h in heads), reverse=True)
    above = {b: order[i - 1] for i, b in enumerate(order)}  # the first range's guest goes behind the last
    head = F.create_map(*[F.lit(x) for h in heads for x in (h.bucket, h.head)])
    first = placed.filter(F.col("id").eqNullSafe(head[F.col("bucket")])).groupBy("bucket").agg(F.min("text").alias("text"))
    behind = F.create_map(*[F.lit(x) for pair in above.items() for x in pair])
    guests = first.select(behind[F.col("bucket")].alias("bucket"), F.lit(True).alias("guest"), F.lit(None).cast("long").alias("id"), "text")
    rows = placed.select("bucket", F.lit(False).alias("guest"), "id", "text").union(guests)
    rows = rows.repartition(many, "bucket").sortWithinPartitions("bucket", "guest", F.desc_nulls_last("id"), "text")
    return rows.select("guest", "id", "text").mapInArrow(_followed, FOLLOWED)


def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared_with_next(documents(spark, sf_dir))


QUERIES = {"op5_spotsigs": op5_spotsigs}
ORACLE: dict[str, str] = {}
