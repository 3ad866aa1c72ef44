"""Repeated passages by a depth-limited radix order of suffixes.

Suffixes are ordered only through `DEPTH` bytes; suffixes that are equal so far
form a group, groups from one document are dropped, and the rest is ordered by
the next digit.  Four digits suffice, each spread over all tasks by its value:

  1. *Anchor*.  Every 50-byte suffix is filed under the least hashed 20-byte
     string that starts in its first 31 bytes (leftmost on ties).  Equal suffixes
     have equal anchors, and neighbours share theirs, so one suffix in about 16
     has to move.
  2. *Reach*.  All suffixes filed under one anchor occurrence, as one string.
     Where a smaller document has the same reach, all of them are repeated there.
  3. *Cell*.  Only where occurrences of an anchor differ in reach, suffixes are taken
     by eights, by their distance to the anchor.  All suffixes of a cell hold the same
     `CORE` bytes: cells whose core no other document has are done, cells that are
     equal in a smaller document are repeated there.
  4. *Suffix*.  Only where cells of one core differ (at the ends of a repeat) each
     50-byte suffix is ordered by itself.

Documents travel in compressed blocks; the digits travel as packed arrays, a row
per block and range of values, each value of a block once with the least document
that has it: an anchor inside a passage that all documents share is one entry a block.
A byte is removed where a suffix that covers it also starts in a document with a
smaller id.

Defined results: null texts are empty; a row whose id is null is left whole and
is no source; rows of one id don't remove from each other; texts below 50 bytes
are left whole; longer ones of any length are read whole; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.llm.scratch import stored
from headroom.llm.texts import U, documents, flat, mix, partitions, slices

DEPTH = 50
ANCHOR = 20
CELL = 8
CORE = DEPTH - CELL + 1  # bytes that all suffixes of a cell share
BLOCK_BYTES = 1 << 19  # numpy holds some 200 bytes for each
PART_BLOCKS = 16  # as many blocks send their digits to one part, on average
PARTS, WIDER = 512, 4  # beyond so many parts they first grow, by this factor at most: rows of few entries cost more than they hold

_BASE = 0xA0761D6478BD642F
_VALUES = np.random.default_rng(9).integers(1, 1 << 63, 256, dtype=np.uint64)
BLOCK = "block long, ids binary, sizes binary, payload binary"
DIGIT = "part int, block long, base long, digits binary, docs binary"
REPLY = "block long, part int, verdict binary"


def rolled(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of every `length`-byte string of `data`, from hashes of powers of two."""
    if len(data) < length:
        return np.zeros(0, np.uint64)
    power, size, done, out = _VALUES[data], 1, 0, None
    rest = length
    while rest:
        if rest & 1:
            if out is None:
                out = power
            else:
                n = len(data) - done - size + 1
                out = out[:n] * U(pow(_BASE, size, 1 << 64)) + power[done : done + n]
            done += size
        rest >>= 1
        if rest:
            n = len(data) - 2 * size + 1
            power, size = power[:n] * U(pow(_BASE, size, 1 << 64)) + power[size : size + n], 2 * size
    return mix(out[: len(data) - length + 1])


def anchored(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors of a block: digit and reach hashes, document index, first and last suffix, and the suffix hashes."""
    suffix = rolled(data, DEPTH)
    if not len(suffix):
        none = np.zeros(0, np.int64)
        return {"digit": suffix, "reach": suffix, "doc": none, "at": none, "low": none, "high": none, "suffix": suffix}
    strings = rolled(data, ANCHOR)
    least = (strings & U(0xFFFFFFFF00000000)) | np.arange(len(strings), dtype=np.uint64)
    width, size = DEPTH - ANCHOR + 1, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if width > size:
        least = np.minimum(least[: size - width], least[width - size :])
    owner = (least & U(0xFFFFFFFF)).astype(np.int64)[: len(suffix)]
    lengths = np.diff(offsets)
    doc = np.repeat(np.arange(len(lengths)), lengths)[: len(suffix)]
    whole = np.arange(len(suffix)) + DEPTH <= offsets[doc + 1]
    change = np.ones(len(suffix), bool)
    change[1:] = (owner[1:] != owner[:-1]) | (doc[1:] != doc[:-1])
    low = np.flatnonzero(whole & (change | np.concatenate(([True], ~whole[:-1]))))
    stop = np.flatnonzero(whole & np.concatenate((change[1:] | ~whole[1:], [True])))
    at = owner[low]
    # an anchor is the least of 31 hashes: mixed again, else nearly all of them fall in the lowest ranges
    return {"digit": mix(strings[at]), "reach": _run(suffix, at, low, stop), "doc": doc[low], "at": at, "low": low, "high": stop, "suffix": suffix}


def _run(suffix: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hashes of the suffixes low..high, which overlap, with their places by the anchor."""
    return mix(suffix[low] * U(0xE7037ED1A0B428DB) + suffix[high] + ((at - low) * 64 + (high - low)).astype(np.uint64) * U(0x8EBC6AF09C88C6E3))


def celled(a: dict[str, np.ndarray], data: np.ndarray, todo: np.ndarray) -> dict[str, np.ndarray]:
    """The anchors `todo` of `anchored` cut into cells: core and content hashes, document index, first and last suffix."""
    at, low, high = (a[k][todo] for k in ("at", "low", "high"))
    near, far = (at - high) // CELL, (at - low) // CELL
    cell, own = _spread(near, far), np.repeat(np.arange(len(at)), far - near + 1)
    at, doc = at[own], a["doc"][todo][own]
    low, high = np.maximum(low[own], at - CELL * cell - CELL + 1), np.minimum(high[own], at - CELL * cell)
    core = rolled(data, CORE)[at - CELL * cell] if len(at) else np.zeros(0, np.uint64)
    digit = mix(core + cell.astype(np.uint64) * U(0xC2B2AE3D27D4EB4F))
    return {"digit": digit, "reach": _run(a["suffix"], at, low, high), "doc": doc, "low": low, "high": high}


def _blocks(batches):
    task, number = TaskContext.get().partitionId(), 0
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        data, offsets = flat(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for low, high in slices(offsets, BLOCK_BYTES):
            cut = offsets[low : high + 1]
            row = [(task << 32) + number, ids[low:high].tobytes(), np.diff(cut).tobytes(), pack.compress(data[cut[0] : cut[-1]].tobytes())]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["block", "ids", "sizes", "payload"])
            number += 1


def _opened(table: pa.Table, row: int = 0):
    """ids, offsets and bytes of a block."""
    ids = np.frombuffer(table["ids"][row].as_py(), np.int64)
    offsets = np.concatenate(([0], np.cumsum(np.frombuffer(table["sizes"][row].as_py(), np.int64))))
    data = zstandard.ZstdDecompressor().decompress(table["payload"][row].as_py(), max_output_size=max(int(offsets[-1]), 1))
    return ids, offsets, np.frombuffer(data, np.uint8)


def _entries(x: dict[str, np.ndarray], ids: np.ndarray):
    """Digits, keys and document ids of anchors or cells."""
    return x["digit"], _keys(x), ids[x["doc"]]


def _merged(digits: np.ndarray, keys: np.ndarray, docs: np.ndarray, parts: int):
    """A block's distinct keys by the range their digit falls in: range, key, least document, and the place of each input among them."""
    if not len(keys):
        none = np.zeros(0, np.int64)
        return none, keys, none, none
    order = np.argsort(keys)
    starts, run, least = _least(keys[order], docs[order])
    first = order[starts]
    part = ((digits[first] >> U(32)) * U(parts) >> U(32)).astype(np.int64)
    by_part = np.argsort(part, kind="stable")
    rank, place = np.empty_like(by_part), np.empty_like(run)
    rank[by_part] = np.arange(len(by_part))
    place[order] = rank[run]
    return part[by_part], keys[first[by_part]], least[by_part], place


def _dealt(block: int, entries: tuple, parts: int):
    """Rows of `DIGIT`: the distinct keys of a range with the least document of each, as its distance from the row's least."""
    part, keys, docs, _ = _merged(*entries, parts)
    edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else []
    for low, high in zip(edges[:-1], edges[1:]):
        base = docs[low:high].min()
        far = docs[low:high].view(U) - base.view(U)
        yield int(part[low]), block, int(base), keys[low:high].tobytes(), far.astype(np.min_scalar_type(far.max())).tobytes()


def _rows(rows, schema: pa.Schema):
    rows = list(rows)
    return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


_DIGIT = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("base", pa.int64()), ("digits", pa.binary()), ("docs", pa.binary())])
_REPLY = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("verdict", pa.binary())])


def _first_digits(batches, parts: int):
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for row in range(len(table)):
            ids, offsets, data = _opened(table, row)
            a = anchored(data, offsets)
            yield from _rows(_dealt(table["block"][row].as_py(), _entries(a, ids), parts), _DIGIT).to_batches()


def _keys(a: dict[str, np.ndarray]) -> np.ndarray:
    """Digit and content of each entry in one number; groups of a digit are runs of it."""
    return (a["digit"] << U(40)) | (a["reach"] >> U(24))


def _gathered(table: pa.Table):
    """All keys of a range with their document ids, and the rows' lengths."""
    keys, docs = [], []
    for row in range(len(table)):
        keys.append(np.frombuffer(table["digits"][row].as_py(), np.uint64))
        far = table["docs"][row].as_py()
        far = np.frombuffer(far, f"u{len(far) // len(keys[-1])}").astype(np.uint64)
        docs.append((far + np.int64(table["base"][row].as_py()).view(U)).view(np.int64))
    return np.concatenate(keys), np.concatenate(docs), [len(x) for x in keys]


def _least(sorted_keys: np.ndarray, docs: np.ndarray):
    """Start of each run of equal keys, run of each entry, least document of each run."""
    new = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
    starts, run = np.flatnonzero(new), np.cumsum(new)
    run -= 1
    return starts, run, np.minimum.reduceat(docs, starts)


def _answered(table: pa.Table, verdict: np.ndarray, lengths: list[int]) -> pa.Table:
    ends = np.cumsum(lengths)
    rows = ((table["block"][i].as_py(), table["part"][i].as_py(), verdict[e - n : e].tobytes()) for i, (n, e) in enumerate(zip(lengths, ends)))
    return _rows(rows, _REPLY)


def judge_reach(table: pa.Table) -> pa.Table:
    """Per anchor (or cell) of a block: 1 if a smaller document has the same reach, 2 if its suffixes have to be ordered, else 0.

    They have to where reaches differ and a document is still open that is not the least of all.
    """
    keys, docs, lengths = _gathered(table)
    order = np.argsort(keys)
    keys, docs = keys[order], docs[order]
    starts, run, least = _least(keys, docs)
    group_starts, group, _ = _least(keys[starts] >> U(40), least)
    reaches = np.diff(np.concatenate((group_starts, [len(starts)])))
    low, high = np.minimum.reduceat(least, group_starts), np.maximum.reduceat(least, group_starts)
    open_group = (reaches > 1) & (high > low)
    verdict = np.zeros(len(keys), np.uint8)
    verdict[order] = np.where(docs > least[run], 1, np.where(open_group[group[run]], 2, 0))
    return _answered(table, verdict, lengths)


def judge_suffix(table: pa.Table) -> pa.Table:
    """Per suffix: 1 if it also starts in a smaller document."""
    keys, docs, lengths = _gathered(table)
    order = np.argsort(keys)
    _, run, least = _least(keys[order], docs[order])
    verdict = np.zeros(len(keys), np.uint8)
    verdict[order] = docs[order] > least[run]
    return _answered(table, verdict, lengths)


def _verdicts(entries: tuple, replies: pa.Table, parts: int) -> np.ndarray:
    """The replies to `_dealt` for each of its entries; those with a smaller document in their own block are repeats anyway."""
    _, _, least, place = _merged(*entries, parts)
    by_part = sorted(zip(replies["part"].to_pylist(), replies["verdict"].to_pylist()))
    out = np.frombuffer(b"".join(v for _, v in by_part), np.uint8)
    return np.where(entries[2] > least[place], np.uint8(1), out[place])


def _spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of the closed ranges low..high, range after range."""
    sizes = high - low + 1
    return np.arange(sizes.sum()) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)


def _at_digit(replies: pa.Table, digit: int) -> pa.Table:
    return replies.filter(pc.equal(replies["digit"], digit))


def _suffixes(a: dict[str, np.ndarray], cells: dict[str, np.ndarray], todo: np.ndarray, ids: np.ndarray):
    """Places and entries of the suffixes of the cells `todo`."""
    low, high = cells["low"][todo], cells["high"][todo]
    at = _spread(low, high)
    return at, (a["suffix"][at], a["suffix"][at], np.repeat(ids[cells["doc"][todo]], high - low + 1))


def _cell_digits(parts: int):
    def deal(block: pa.Table, replies: pa.Table) -> pa.Table:
        ids, offsets, data = _opened(block)
        a = anchored(data, offsets)
        cells = celled(a, data, _verdicts(_entries(a, ids), replies, parts) == 2)
        return _rows(_dealt(block["block"][0].as_py(), _entries(cells, ids), parts), _DIGIT)

    return deal


def _suffix_digits(parts: int):
    def deal(block: pa.Table, replies: pa.Table) -> pa.Table:
        ids, offsets, data = _opened(block)
        a = anchored(data, offsets)
        cells = celled(a, data, _verdicts(_entries(a, ids), _at_digit(replies, 1), parts) == 2)
        todo = _verdicts(_entries(cells, ids), _at_digit(replies, 2), parts) == 2
        return _rows(_dealt(block["block"][0].as_py(), _suffixes(a, cells, todo, ids)[1], parts), _DIGIT)

    return deal


SPAN = "doc long, text binary, size long, starts array<long>, ends array<long>"
_SPAN = pa.schema([("doc", pa.int64()), ("text", pa.binary()), ("size", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])


def _repeats(parts: int):
    def find(block: pa.Table, replies: pa.Table) -> pa.Table:
        ids, offsets, data = _opened(block)
        a = anchored(data, offsets)
        reach = _verdicts(_entries(a, ids), _at_digit(replies, 1), parts)
        cells = celled(a, data, reach == 2)
        content = _verdicts(_entries(cells, ids), _at_digit(replies, 2), parts)
        at, entries = _suffixes(a, cells, content == 2, ids)
        at = at[_verdicts(entries, _at_digit(replies, 3), parts) == 1]
        cover = np.zeros(len(data) + 1, np.int32)
        for low, high in ((a["low"][reach == 1], a["high"][reach == 1]), (cells["low"][content == 1], cells["high"][content == 1]), (at, at)):
            np.add.at(cover, low, 1)
            np.add.at(cover, high + DEPTH, -1)
        cover = np.cumsum(cover)[:-1] > 0
        rows = []
        for i, doc in enumerate(ids):
            own = cover[offsets[i] : offsets[i + 1]]
            edge = np.diff(np.concatenate(([0], own.view(np.int8), [0])))
            text = data[offsets[i] : offsets[i + 1]]
            rows.append((int(doc), text[~own].tobytes(), len(text), np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)))
        return _rows(rows, _SPAN)

    return find


def number_of_parts(blocks: int, tasks: int) -> int:
    """Ranges of digits: two a task or one for `PART_BLOCKS` blocks, beyond `PARTS` fewer and larger ones."""
    wanted = max(2 * tasks, blocks // PART_BLOCKS)
    return max(min(wanted, PARTS), wanted // WIDER)


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """(doc, text, size, starts, ends): the bytes kept, the size before, and the byte spans removed as repeats."""
    spark = docs.sparkSession
    own = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    blocks = stored(own.filter("doc is not null").mapInArrow(_blocks, BLOCK), "blocks")
    parts = parts or number_of_parts(blocks.count(), partitions(spark))
    whole = own.filter("doc is null").select("doc", F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("text"))
    none = F.array().cast("array<long>")
    whole = whole.select("doc", "text", F.octet_length("text").cast("long").alias("size"), none.alias("starts"), none.alias("ends"))

    anchors = blocks.mapInArrow(lambda it: _first_digits(it, parts), DIGIT)
    one = stored(anchors.groupBy("part").applyInArrow(judge_reach, REPLY), "reaches").withColumn("digit", F.lit(1))
    cells = blocks.groupBy("block").cogroup(one.groupBy("block")).applyInArrow(_cell_digits(parts), DIGIT)
    two = stored(cells.groupBy("part").applyInArrow(judge_reach, REPLY), "cells").withColumn("digit", F.lit(2))
    replies = one.union(two)
    suffixes = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_suffix_digits(parts), DIGIT)
    three = stored(suffixes.groupBy("part").applyInArrow(judge_suffix, REPLY), "suffixes").withColumn("digit", F.lit(3))
    found = blocks.groupBy("block").cogroup(replies.union(three).groupBy("block")).applyInArrow(_repeats(parts), SPAN)
    return found.union(whole)


def _digest(batches):
    for batch in batches:
        kept = [hashlib.sha256(x.as_buffer()).hexdigest() for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), batch.column(4), pa.array(kept, pa.string())],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def op9_suffix_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(documents(spark, sf_dir))
    removed = F.col("size") - F.octet_length("text")
    return found.select("doc", "text", "size", removed.cast("long").alias("removed"), F.size("starts").cast("long").alias("spans")).mapInArrow(
        _digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


QUERIES = {"op9_suffix_radix": op9_suffix_radix}
ORACLE: dict[str, str] = {}
