"""Vectorised text helpers: texts as flat bytes, words and shingles as 64-bit hashes.

All functions work on whole Arrow columns in slices of about a megabyte, so that
no Python object is made per word.  A null text is an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20

U = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
NO_LETTER = np.ones(256, bool)  # for words of letters and digits; bytes from 128 on belong to letters
NO_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64; kept and grown per process."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 4096)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and the n + 1 offsets of the texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.type not in (pa.string(), pa.large_string()):
        column = column.cast(pa.string())
    column = pc.fill_null(column, "")
    wide = np.int64 if column.type == pa.large_string() else np.int32
    _, places, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `size` bytes; a longer text stands alone."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def words(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in A-Z lower case, index of each text's first word plus the total)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~gaps[data]
    cuts = offsets[:-1][offsets[:-1] < n]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    begin[cuts] = inside[cuts]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    end[last] = inside[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[LOWER[data]] * powers(_BASE, n), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(_INVERSE, n)[starts]), np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, length: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `length` words, text after text, with their n + 1 offsets.

    A text of fewer words has its whole sequence as one shingle, one without words none.
    """
    counts = np.diff(first)
    many = np.where(counts >= length, counts - length + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate(([0], np.cumsum(many)))
    out = np.zeros(offsets[-1], np.uint64)
    factors = powers(0xD6E8FEB86659FD93, length + 1)[1:]
    n = len(hashes) - length + 1
    if n > 0:
        runs = np.zeros(n, np.uint64)
        for k in range(length):
            runs += hashes[k : n + k] * factors[k]
        whole = np.flatnonzero(counts >= length)
        take = np.arange(many[whole].sum()) - np.repeat(np.cumsum(many[whole]) - many[whole], many[whole])
        out[np.repeat(offsets[whole], many[whole]) + take] = runs[np.repeat(first[whole], many[whole]) + take]
    for i in np.flatnonzero((counts > 0) & (counts < length)):
        part = hashes[first[i] : first[i + 1]]
        out[offsets[i] : offsets[i] + 1] = (part * factors[: len(part)]).sum(dtype=np.uint64)
        out[offsets[i] : offsets[i] + 1] += U(int(counts[i]) * 0x632BE59BD9B4E019 % (1 << 64))
    return mix(out), offsets


def per_text(reducer, values: np.ndarray, offsets: np.ndarray, empty) -> np.ndarray:
    """`reducer.reduceat` per text; texts without values get `empty`."""
    out = np.full(len(offsets) - 1, empty, values.dtype)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        out[full] = reducer.reduceat(values, offsets[full])
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def share_of(key, parts: int):
    """crc32 of the id as text modulo `parts`, the split into learning and held-out rows."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
