"""Keyed Parquet store: batches are appended, the newest row of a key is chosen when it is read.

Layout below the store's folder:

  * `meta.json`: schema, key columns, order and time column, so that a store without a row still reads as a table;
  * `deltas/__batch=<number>@<label>/__month=<month>/`: the rows of one batch and nothing else.  The folders are the
    ledger: a label that is there already keeps its number and its folder is written anew, so a batch may run again;
  * `base/__month=<month>/upto=<number>/`: a month's rows with the batches up to that number merged in.

Of the rows of a key the last in `order` stays, on a tie that of the later batch.  A key is its columns, nulls
included, not a joined text.  A row whose `__deleted` is true takes the key out until a later row comes.  Months
without unmerged batches are read as they are; compaction merges month by month and leaves a readable store at every
step.  One writer at a time.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headroom.operators.columns import quoted
from headroom.operators.filters import dedupe_last
from headroom.scale import as_columns, put_text

DELETED, BATCH, MONTH = "__deleted", "__batch", "__month"
COMPACT_EVERY = 16


def composite_id(fields, delimiter: str = "-") -> Column:
    """Present key fields joined; null fields are left out."""
    parts = [quoted(f).cast("string") for f in as_columns(fields)]
    return F.concat_ws(delimiter, *parts)


def with_id(df: DataFrame, id_fields, delimiter: str = "-") -> DataFrame:
    return df.withColumn("id_key", composite_id(id_fields, delimiter))


class _Files:
    """Folder names and deletion on the store's own file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.make = spark._jvm.org.apache.hadoop.fs.Path
        self.system = self.make(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def folders(self, name: str, done: bool = False) -> list[str]:
        """Names of the folders in `name`; with `done` only of those whose writing was finished."""
        path = self.make(f"{self.root}/{name}")
        if not self.system.exists(path):
            return []
        found = [s.getPath() for s in self.system.listStatus(path) if s.isDirectory()]
        return sorted(p.getName() for p in found if not done or self.system.exists(self.make(p, "_SUCCESS")))

    def text(self, name: str) -> str | None:
        path = self.make(f"{self.root}/{name}")
        if not self.system.exists(path):
            return None
        stream = self.system.open(path)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def drop(self, name: str) -> None:
        self.system.delete(self.make(f"{self.root}/{name}"), True)


@dataclass
class _Meta:
    schema: T.StructType
    keys: list[str]
    order: list[str]
    time: str
    delimiter: str

    def text(self) -> str:
        return json.dumps({**self.__dict__, "schema": json.loads(self.schema.json())})

    @staticmethod
    def read(files: _Files) -> _Meta | None:
        text = files.text("meta.json")
        if text is None:
            return None
        held = json.loads(text)
        return _Meta(T.StructType.fromJson(held.pop("schema")), **held)

    def merged(self, schema: T.StructType) -> T.StructType:
        """This schema and the columns that `schema` adds; a type must not change."""
        known = {f.name: f.dataType for f in self.schema.fields}
        for field in schema.fields:
            if known.setdefault(field.name, field.dataType) != field.dataType:
                raise ValueError(f"column {field.name} is stored as {known[field.name].simpleString()}, not {field.dataType.simpleString()}")
        return T.StructType([T.StructField(n, t) for n, t in known.items()])


def _number(folder: str) -> int:
    return int(re.match(rf"{BATCH}=(\d+)@", folder).group(1))


def _label(folder: str) -> str:
    return folder.split("@", 1)[1]


def store_exists(spark: SparkSession, path: str) -> bool:
    """Whether a batch, even one without rows, has been stored at `path`."""
    return _Files(spark, path).text("meta.json") is not None


def upsert_by_key(
    df: DataFrame, target: str, id_fields, order, time: str = "valid_from", delimiter: str = "-", label: str | None = None,
    compact_every: int | None = COMPACT_EVERY,
) -> None:
    """Append the rows of `df` to the store at `target`, the newest of each key only.

    The month comes from `time`, which belongs into `id_fields` so that a key never moves between months.  A batch
    writes its own rows and reads none.  `label` names the batch: writing a label again replaces its rows.  Once
    `compact_every` batches wait, those before this one are merged first.
    """
    spark, files = df.sparkSession, _Files(df.sparkSession, target)
    keys, order = as_columns(id_fields), as_columns(order)
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in df.drop(DELETED).schema.fields])
    held = _Meta.read(files)
    meta = _Meta(held.merged(plain) if held else plain, keys, order, time, delimiter)
    if held is None or held != meta:
        put_text(spark, f"{files.root}/meta.json", meta.text())
    waiting = [b for b in files.folders("deltas") if label is None or _label(b) != label]
    if compact_every and len(waiting) >= compact_every:
        compact_store(spark, target, before=waiting)
    taken = files.folders("deltas")
    own = [b for b in taken if label is not None and _label(b) == label]
    merged = [int(u.split("=")[1]) for m in files.folders("base") for u in files.folders(f"base/{m}", done=True)]
    number = _number(own[0]) if own else 1 + max([*(_number(b) for b in taken), *merged], default=0)
    deleted = F.coalesce(F.col(DELETED), F.lit(False)) if DELETED in df.columns else F.lit(False)
    month = F.coalesce(F.date_format(F.col(time).cast("timestamp"), "yyyy-MM"), F.lit("none"))
    newest = dedupe_last(df.withColumns({DELETED: deleted}), keys, order).withColumn(MONTH, month)
    path = f"{files.root}/deltas/{BATCH}={number:09d}@{label or number}"
    newest.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(path)


def _parts(files: _Files, without: str | None = None, only: list[str] | None = None):
    """(merged folder per month, unmerged folders per month)."""
    base = {}
    for month in files.folders("base"):
        done = files.folders(f"base/{month}", done=True)
        if done:
            base[month] = max(int(u.split("=")[1]) for u in done)
    deltas: dict[str, list[str]] = {}
    for batch in files.folders("deltas", done=True):
        if (without is not None and _label(batch) == without) or (only is not None and batch not in only):
            continue
        for month in files.folders(f"deltas/{batch}"):
            if _number(batch) > base.get(month, -1):
                deltas.setdefault(month, []).append(f"deltas/{batch}/{month}")
    return {m: f"base/{m}/upto={n}" for m, n in base.items()}, deltas


def _rows(spark: SparkSession, files: _Files, meta: _Meta, base: list[str], deltas: list[str]) -> DataFrame:
    """All rows of the folders, with the number of their batch (0: merged)."""
    fields = [*meta.schema.fields, T.StructField(DELETED, T.BooleanType())]
    parts = [spark.createDataFrame([], T.StructType(fields)).withColumn("__number", F.lit(0))]
    if base:
        parts.append(spark.read.schema(T.StructType(fields)).parquet(*[f"{files.root}/{b}" for b in base]).withColumn("__number", F.lit(0)))
    if deltas:
        dealt = T.StructType([*fields, T.StructField(BATCH, T.StringType())])
        found = spark.read.schema(dealt).option("basePath", f"{files.root}/deltas").parquet(*[f"{files.root}/{d}" for d in deltas])
        parts.append(found.select(*[f.name for f in fields], F.split(BATCH, "@")[0].cast("int").alias("__number")))
    out = parts[-1]
    for part in parts[1:-1]:
        out = out.unionByName(part)
    return out


def _merged(spark, files, meta, base: dict[str, str], deltas: dict[str, list[str]]) -> DataFrame:
    """Newest row of each key, tombstones included."""
    quiet = [path for month, path in base.items() if month not in deltas]
    busy = [path for month, path in base.items() if month in deltas]
    rows = _rows(spark, files, meta, busy, [d for month in deltas for d in deltas[month]])
    newest = dedupe_last(rows, meta.keys, [*meta.order, "__number"]) if deltas else rows
    return newest.unionByName(_rows(spark, files, meta, quiet, [])) if quiet and deltas else _rows(spark, files, meta, quiet, []) if quiet else newest


def read_store(spark: SparkSession, target: str, without: str | None = None, months: list[str] | None = None) -> DataFrame:
    """Rows of a store, with `id_key`; `without` leaves out the batch of that label, `months` (yyyy-MM) restricts the scan."""
    files = _Files(spark, target)
    meta = _Meta.read(files)
    if meta is None:
        raise FileNotFoundError(f"no store at {target}")
    base, deltas = _parts(files, without)
    if months is not None:
        wanted = {f"{MONTH}={m}" for m in months}
        base, deltas = ({m: p for m, p in x.items() if m in wanted} for x in (base, deltas))
    rows = _merged(spark, files, meta, base, deltas)
    return with_id(rows.where(~F.col(DELETED)).drop("__number", DELETED), meta.keys, meta.delimiter)


def compact_store(spark: SparkSession, target: str, before: list[str] | None = None) -> list[str]:
    """Merge the waiting batches (or those named in `before`) into their months, a month at a time; returns the months.

    A month's new folder counts as soon as it is complete; only then its batches go.
    """
    files = _Files(spark, target)
    meta = _Meta.read(files)
    batches = [b for b in files.folders("deltas", done=True) if before is None or b in before]
    if not batches:
        return []
    base, deltas = _parts(files, only=batches)
    top = max(_number(b) for b in batches)
    for month in deltas:
        rows = _merged(spark, files, meta, {m: p for m, p in base.items() if m == month}, {month: deltas[month]})
        rows.drop("__number").write.mode("overwrite").parquet(f"{files.root}/base/{month}/upto={top}")
        for old in files.folders(f"base/{month}"):
            if old != f"upto={top}":
                files.drop(f"base/{month}/{old}")
    for batch in batches:
        files.drop(f"deltas/{batch}")
    return [m.split("=")[1] for m in deltas]
