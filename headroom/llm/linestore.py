"""Line dedup that can be taken back: sharded cuckoo filters backed by exact reference-count tables.

A line's key is the line without white space at its ends and with A-Z in lower
case; keys of at least `MIN_CHARS` code points count.  A `LineStore` keeps, below
one folder, three tables; a batch of documents only adds its own part to each:

  * `postings`: (doc, hi, lo, sign), the 128-bit digest of every key of every
    document; sign -1 takes a document's keys out again.  Of a document and key
    the newest batch counts.
  * `counts`: (hi, lo, docs, largest), how many documents hold a key and the
    largest of their ids; of a key the newest batch counts.  These reference
    counts are exact and decide alone.
  * `filters`: a cuckoo filter of the live keys per shard of the digests.  A key
    of a new batch that its filter does not hold is certainly new and is counted
    from the batch alone; only the others are looked up in the exact tables.
    Keys enter a filter when their first document comes and leave it with the last.

Shards hold about `SHARD_KEYS` keys; a filter that fills up makes the number of
shards grow.  A batch that runs again replaces its own part.

Keys that more than a share of all postings have (at most `HEAVY` per shuffle
partition, hence a bounded table) are joined by broadcast, all others by shuffle.

Defined results: a null or empty text is one empty line; rows without an id count
for nothing and keep all lines; rows of one id are one document for counting and
are cleaned each by itself; digests have 128 bits of BLAKE2b and are taken for the
keys; texts of any length are read whole, one at a time; other columns are passed
on and may have any name but those that begin with two underscores; an empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.llm.cuckoo import FULL, SLOTS, Cuckoo, buckets_for
from headroom.llm.scratch import drop_stored, shared_folder, stored, written
from headroom.llm.texts import documents, partitions

MIN_CHARS = 20
MIN_DOCS = 3
SHARD_KEYS = 1 << 16
HEAVY = 4

WHITE = b" \t\n\x0b\x0c\r"
LINES = "__doc long, __mark long, hi long, lo long"
FILTER = "shards int, shard int, buckets int, cells binary, stash binary, load long"
_FILTER = pa.schema([("shards", pa.int32()), ("shard", pa.int32()), ("buckets", pa.int32()), ("cells", pa.binary()), ("stash", pa.binary()), ("load", pa.int64())])
POSTING = "doc long, hi long, lo long, sign int"
COUNT = "hi long, lo long, docs long, largest long"


def line_key(line: bytes) -> bytes | None:
    """Digest of a line's key; None if the key is too short to count."""
    key = line.strip(WHITE).lower()
    if len(key) < MIN_CHARS or (len(key) < 4 * MIN_CHARS and len(key.decode("utf-8", "replace")) < MIN_CHARS):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _lines(batches):
    """(doc, mark, digest) of the distinct keys of every row."""
    for batch in batches:
        docs, marks, counts, digests = [], [], [], []
        for doc, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            own = {line_key(line) for line in text.as_buffer().to_pybytes().split(b"\n")} - {None} if text.is_valid else ()
            if own:
                docs.append(doc)
                marks.append(mark)
                counts.append(len(own))
                digests.extend(own)
        pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.array(docs, np.int64), counts)), pa.array(np.repeat(np.array(marks, np.int64), counts)),
            pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1])),
        ], names=["__doc", "__mark", "hi", "lo"])


def _marked(docs: DataFrame, key: str, text: str) -> DataFrame:
    """`docs` with the id as a number and a mark of the text, which together name a row's content."""
    return docs.withColumns({"__doc": F.col(key).cast("long"), "__text": F.col(text).cast("string"), "__mark": F.xxhash64(F.col(text).cast("string"))})


def keyed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(__doc, __mark, hi, lo): the distinct counted keys of every row with an id."""
    own = _marked(docs, key, text).filter("__doc is not null").select("__doc", "__mark", "__text")
    return own.mapInArrow(_lines, LINES)


def _shard(shards: int):
    return F.col("hi").bitwiseAND(F.lit(shards - 1)).cast("int")


def _filter_row(shards: int, shard: int, filter: Cuckoo) -> pa.Table:
    buckets, cells, stash, load = filter.parts()
    return pa.table([[shards], [shard], [buckets], [cells], [stash], [load]], schema=_FILTER)


def _opened(table: pa.Table) -> Cuckoo:
    row = table.slice(0, 1).to_pylist()[0]
    return Cuckoo(row["buckets"], row["cells"], row["stash"], row["load"])


def _built(shards: int):
    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        filter = Cuckoo(buckets_for(2 * len(table)))  # room for as many again
        filter.insert(table["lo"].to_numpy())
        return _filter_row(shards, key[0].as_py(), filter)

    return build


def _probed(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """Keys of a shard with `seen`: false where the filter rules the key out."""
    seen = _opened(filters).contains(keys["lo"].to_numpy()) if len(filters) else np.zeros(len(keys), bool)
    return pa.table({"hi": keys["hi"], "lo": keys["lo"], "seen": pa.array(seen)})


def _changed(shards: int):
    def change(key: tuple[pa.Scalar, ...], keys: pa.Table, filters: pa.Table) -> pa.Table:
        if not len(keys):
            return filters.select(_FILTER.names)
        step, low = keys["step"].to_numpy(), keys["lo"].to_numpy()
        filter = _opened(filters) if len(filters) else Cuckoo(buckets_for(2 * len(keys)))
        filter.delete(low[step < 0])
        filter.insert(low[step > 0])
        return _filter_row(shards, key[0].as_py(), filter)

    return change


class LineStore:
    """Reference counts of line keys below `path`, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str | None = None, shard_keys: int = SHARD_KEYS):
        import uuid

        self.spark, self.shard_keys = spark, shard_keys
        self.path = path or f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"

    def _batches(self, table: str) -> list[int]:
        """Numbers of the batches stored so far (folder names)."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        done = (x.getPath() for x in files.listStatus(folder))
        return sorted(int(p.getName().split("=")[1]) for p in done if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def _read(self, table: str, schema: str, skip: int | None = None) -> DataFrame:
        kept = [b for b in self._batches(table) if b != skip]
        parts = [self.spark.read.schema(schema).parquet(f"{self.path}/{table}/batch={b}").withColumn("batch", F.lit(b)) for b in kept]
        if not parts:
            return self.spark.createDataFrame([], f"{schema}, batch int")
        out = parts[0]
        for part in parts[1:]:
            out = out.unionAll(part)
        return out

    def _write(self, df: DataFrame, table: str, batch: int) -> None:
        written(df, f"{self.path}/{table}/batch={batch}")

    def counts(self, skip: int | None = None) -> DataFrame:
        """(hi, lo, docs, largest) of every live key."""
        held = self._read("counts", COUNT, skip)
        if len([b for b in self._batches("counts") if b != skip]) > 1:  # else every key stands once
            held = held.groupBy("hi", "lo").agg(F.max_by(F.struct("docs", "largest"), "batch").alias("s")).select("hi", "lo", "s.*")
        return held.filter("docs > 0").select("hi", "lo", "docs", "largest")

    def filters(self, skip: int | None = None) -> DataFrame:
        """The newest filter of every shard of the newest number of shards."""
        held = self._read("filters", FILTER, skip)
        newest = held.groupBy("shards", "shard").agg(F.max_by(F.struct("buckets", "cells", "stash", "load"), "batch").alias("s"))
        top = held.select(F.max("shards")).first()[0]
        return newest.filter(F.col("shards") == F.lit(top)).select("shards", "shard", "s.*")

    def _tally(self, postings: DataFrame) -> DataFrame:
        """Documents and largest id per key; of a document and key the newest batch decides."""
        live = postings.groupBy("hi", "lo", "doc").agg(F.max_by("sign", "batch").alias("sign"))
        on = F.when(F.col("sign") > 0, F.col("doc"))
        return live.groupBy("hi", "lo").agg(F.count(on).alias("docs"), F.max(on).alias("largest"))

    def insert(self, docs: DataFrame, batch: int, key: str = "doc_id", text: str = "text") -> None:
        """Count the lines of `docs`; documents whose id is stored with other lines gain these lines."""
        lines = keyed_lines(docs, key, text)
        self._write(lines.select(F.col("__doc").alias("doc"), "hi", "lo", F.lit(1).alias("sign")), "postings", batch)
        self._settle(batch)

    def delete(self, docs: DataFrame, batch: int, key: str = "doc_id") -> None:
        """Take the documents of these ids out again, with all lines they brought."""
        ids = docs.select(F.col(key).cast("long").alias("doc")).filter("doc is not null").distinct()
        held = self._read("postings", POSTING, batch).join(ids, "doc", "left_semi").groupBy("doc", "hi", "lo").agg(F.max_by("sign", "batch").alias("sign"))
        self._write(held.filter("sign > 0").select("doc", "hi", "lo", F.lit(-1).alias("sign")), "postings", batch)
        self._settle(batch)

    def _settle(self, batch: int) -> None:
        own = self._read("postings", POSTING).filter(F.col("batch") == F.lit(batch))
        if not [b for b in self._batches("filters") if b != batch]:
            self._write(self._tally(own), "counts", batch)
            self._rebuild(batch)
            return
        filters = stored(self.filters(batch), "filters")
        shards = filters.select(F.max("shards")).first()[0]
        touched = own.select("hi", "lo").distinct().withColumn("shard", _shard(shards))
        probed = stored(touched.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(_probed, "hi long, lo long, seen boolean"), "probed")
        maybe, new = probed.filter("seen").select("hi", "lo"), probed.filter("not seen").select("hi", "lo")
        postings = self._read("postings", POSTING)
        rows = own.join(new, ["hi", "lo"], "left_semi").unionByName(postings.join(maybe, ["hi", "lo"], "left_semi"))
        self._write(self._tally(rows), "counts", batch)
        now = self._read("counts", COUNT).filter(F.col("batch") == F.lit(batch)).select("hi", "lo", (F.col("docs") > 0).alias("now"))
        before = self.counts(batch).join(maybe, ["hi", "lo"], "left_semi").select("hi", "lo", F.lit(True).alias("before"))
        step = F.when(F.col("now") & F.col("before").isNull(), 1).when(~F.col("now") & F.col("before").isNotNull(), -1).otherwise(0)
        steps = now.join(before, ["hi", "lo"], "left").select("hi", "lo", step.alias("step"), _shard(shards).alias("shard")).filter("step <> 0")
        self._write(steps.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(_changed(shards), FILTER), "filters", batch)
        room = F.col("load") > F.col("buckets") * F.lit(SLOTS * (1 + FULL) / 2)
        if self.filters().filter(room).limit(1).count():
            self._rebuild(batch)
        for table in (filters, probed):
            drop_stored(table)

    def _rebuild(self, batch: int) -> None:
        """All filters anew from the exact counts, with as many shards as the keys need."""
        live = self.counts()
        need = live.count() / self.shard_keys
        old = self._read("filters", FILTER, batch).select(F.max("shards")).first()[0] or 1
        shards = max(1 << max(int(np.ceil(np.log2(max(need, 1)))), 0), old)
        filters = live.withColumn("shard", _shard(shards)).select("shard", "lo").groupBy("shard").applyInArrow(_built(shards), FILTER)
        if not need:
            filters = self.spark.createDataFrame([(shards, 0, *Cuckoo(buckets_for(0)).parts())], FILTER)
        self._write(filters, "filters", batch)

    def compact(self, batch: int) -> None:
        """All batches as one, numbered `batch`, which has to be the newest: taken-out postings and outdated counts go."""
        live = self._read("postings", POSTING).groupBy("doc", "hi", "lo").agg(F.max_by("sign", "batch").alias("sign")).filter("sign > 0")
        parts = {"postings": live.select("doc", "hi", "lo", F.lit(1).alias("sign")), "counts": self.counts(), "filters": self.filters()}
        old = {table: [b for b in self._batches(table) if b != batch] for table in parts}
        fresh = {table: stored(part, table) for table, part in parts.items()}
        for table, part in fresh.items():
            self._write(part, table, batch)
        for table, numbers in old.items():
            for number in numbers:
                self._drop(f"{table}/batch={number}")
            drop_stored(fresh[table])

    def _drop(self, name: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def deduplicated(self, docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
        """`docs` with `__kept` (the text without lines that `min_docs` documents hold, but in the largest), `__lines` and `__dropped`."""
        repeated = stored(self.counts().filter(F.col("docs") >= min_docs), "repeated")
        lines = stored(keyed_lines(docs, key, text), "keyed")
        limit = max(lines.count() // (HEAVY * partitions(self.spark)), 1)
        heavy = repeated.filter(F.col("docs") > limit).select("hi", "lo", F.col("largest").alias("__top"))
        tagged = lines.join(F.broadcast(heavy), ["hi", "lo"], "left")  # fewer than HEAVY keys a partition
        other = repeated.filter(F.col("docs") <= limit).select("hi", "lo", "largest")
        rest = tagged.filter("__top is null").select("__doc", "__mark", "hi", "lo").join(other, ["hi", "lo"]).filter("__doc <> largest")
        drops = tagged.filter("__doc <> __top").select("__doc", "__mark", "hi", "lo").unionByName(rest.select("__doc", "__mark", "hi", "lo"))
        lists = drops.groupBy("__doc", "__mark").agg(F.collect_set(F.struct("hi", "lo")).alias("__drop"))
        own = _marked(docs, key, text)
        joined = own.join(lists, (own["__doc"] == lists["__doc"]) & (own["__mark"] == lists["__mark"]), "left").select(
            *[own[c] for c in docs.columns], own["__text"], lists["__drop"])
        found = joined.select(F.struct(*docs.columns).alias("__row"), "__text", F.col("__drop.hi").alias("__hi"), F.col("__drop.lo").alias("__lo"))
        row = found.schema["__row"].dataType.simpleString()
        cleaned = found.mapInArrow(_cleaned, f"__row {row}, __kept string, __lines long, __dropped long")
        return cleaned.select("__row.*", "__kept", "__lines", "__dropped")


def _cleaned(batches):
    for batch in batches:
        texts, high, low = batch.column(1), batch.column(2), batch.column(3)
        kept, lines, dropped = [], [], []
        for i in range(len(batch)):
            text = texts[i].as_buffer().to_pybytes() if texts[i].is_valid else b""
            parts = text.split(b"\n")
            lines.append(len(parts))
            if high[i].is_valid:
                pairs = np.stack([high[i].values.to_numpy(), low[i].values.to_numpy()], axis=1)
                away = {p.tobytes() for p in pairs}
                parts = [p for p in parts if line_key(p) not in away]
                text = b"\n".join(parts)
            dropped.append(lines[-1] - len(parts))
            kept.append(text.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
            names=["__row", "__kept", "__lines", "__dropped"])


def op11_cuckoo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    store = LineStore(spark)
    store.insert(docs, 0)
    clean = store.deduplicated(docs)
    return clean.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"),
                        F.sha2(F.col("__kept").cast("binary"), 256).alias("kept_sha256"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
QUERIES = {"op11_cuckoo_lines": op11_cuckoo_lines}
ORACLE = {"op11_cuckoo_lines": rf"""with d as (select row_number() over () rn, doc_id, string_split(coalesce(text,''), chr(10)) ls from documents),
 l as (select rn, doc_id, unnest(ls) line, unnest(range(len(ls))) i from d),
 k as (select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{_UPPER}', '{_LOWER}') key from l),
 h as (select key, max(doc_id) largest from k where length(key) >= {MIN_CHARS} group by key having count(distinct doc_id) >= {MIN_DOCS}),
 m as (select k.*, coalesce(doc_id <> largest, false) gone from k left join h using (key))
select any_value(doc_id) doc_id, count(*) n_lines, count(*) filter (gone) n_dropped,
 sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) kept_sha256 from m group by rn"""}
