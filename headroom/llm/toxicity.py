"""Toxicity by compression distance with two trained zstandard dictionaries.

One dictionary is trained by zstandard on ordinary text, one on spans of toxic text;
the second is used in front of the first, so that ordinary passages cost the same in
both.  Overlapping windows of a text are compressed with each; the bytes that the
toxic dictionary saves are compared with thresholds, and the numbers of windows that
reach each threshold are turned into a probability by a logistic calibration, so that 0.5
is the decision.

Toxic texts are mostly ordinary words.  The spans to train on are therefore runs of
byte strings (`GRAM` bytes) that significantly more toxic than ordinary texts hold
(log odds above `ODDS`, and above `Z` times their standard error), with a byte on
either side.  Dictionaries and calibration never see the same text: the dictionaries are
trained on all but one in `HELD` of the texts, the calibration is fitted to the scores of
the others.  A score of 0.5 is where a text is as likely toxic as not were the classes
of equal size, or higher, as far as at most `FALSE_ALARMS` of the ordinary texts of the
calibration exceed it.
Dictionaries are used as raw content: a short window has no coding tables, and a
match saves whole bytes.  Each window ends in a phrase that both dictionaries
hold, so that the fixed cost of a first match is always paid.

Fitting uses at most `PER_CLASS` labelled texts a class with `CHARACTERS`
characters each, from all over the text.  Scoring reads whole texts.

Defined results: null and empty texts have no window and get the calibrated score
of no savings; without labels of both classes every score is the share of toxic
labels (0 without labels); repeated rows score alike; a text of any length is read
whole, window by window; a null label is no label; other columns are passed on (the
score's name has to be free); an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.llm.learning import class_sample, logistic, sigmoid
from headroom.llm.texts import LOWER, SPACE, U, documents, flat, share_of, slices

PER_CLASS = 4000
CHARACTERS = 4096
WINDOW, HOP = 48, 24  # so few literals stay uncoded, and every match saves whole bytes
ORDINARY, TOXIC = 16384, 4096  # sizes of the dictionaries
GRAM = 6  # as many bytes as the shortest match
ODDS, Z = 2.0, 4.0
HELD = 3
FALSE_ALARMS = 0.015
SEEN = 30  # times its size that a dictionary is trained on; spans are repeated up to it
THRESHOLDS = np.array([1, 2, 3, 4, 5, 6, 8, 10, 13])  # bytes saved; a span of GRAM bytes saves about 3
PRIOR = 20  # windows by which the share of windows of a short text is drawn to zero

TAIL = b" of this window and its end"


def _trained(samples: list[bytes], size: int, **shape: int) -> bytes:
    """Content trained by zstandard from the samples; the distinct samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples * max(1, -(-SEEN * size // max(sum(map(len, samples)), 1))), **shape).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(dict.fromkeys(samples))[-size:]


def _plain(data: np.ndarray) -> bytes:
    """Bytes with A-Z in lower case and any white space as a space."""
    low = LOWER[data]
    low[SPACE[low]] = 32
    return low.tobytes()


def _grams(text: bytes) -> np.ndarray:
    """Every string of GRAM bytes as a number."""
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    out = np.zeros(max(len(data) - GRAM + 1, 0), np.uint64)
    for k in range(GRAM if len(out) else 0):
        out = out << U(8) | data[k : k + len(out)]
    return out


def characteristic(toxic: list[bytes], ordinary: list[bytes]) -> np.ndarray:
    """The strings of GRAM bytes that significantly more of the toxic texts hold."""
    grams, n = np.unique(np.concatenate([np.unique(_grams(t)) for t in toxic] or [_grams(b"")]), return_counts=True)
    m = np.zeros(len(grams), np.int64)
    for text in ordinary:
        own = np.unique(_grams(text))
        at = np.searchsorted(grams, own)
        own, at = own[at < len(grams)], at[at < len(grams)]
        m[at[grams[at] == own]] += 1
    rest, others = len(toxic) - n, len(ordinary) - m
    odds = np.log((n + 0.5) / (rest + 0.5)) - np.log((m + 0.5) / (others + 0.5))
    error = np.sqrt(1 / (n + 0.5) + 1 / (rest + 0.5) + 1 / (m + 0.5) + 1 / (others + 0.5))
    return grams[(odds > ODDS) & (odds > Z * error)]


def _spans(toxic: list[bytes], grams: np.ndarray) -> list[bytes]:
    """Training samples: runs of characteristic strings with a byte on either side, weighted by the log of their texts."""
    texts = Counter()
    for text in toxic:
        edge = np.diff(np.concatenate(([0], np.isin(_grams(text), grams).view(np.int8), [0])))
        texts.update({text[max(a - 1, 0) : b + GRAM] for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))})
    return [span for span, n in sorted(texts.items()) for _ in range(n.bit_length())]


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """The two dictionaries from distinct plain texts."""
    own = _trained([t[i : i + 256] for t in ordinary for i in range(0, len(t), 256)], ORDINARY)
    return own, _trained(_spans(toxic, characteristic(toxic, ordinary)), TOXIC, d=GRAM, k=50) + own


@lru_cache(maxsize=4)
def _compressors(ordinary: bytes, toxic: bytes):
    made = []
    for content in (ordinary + TAIL, toxic + TAIL):
        log = max(14, len(content).bit_length() + 1)  # so that every place of the dictionary can be found
        params = zstandard.ZstdCompressionParameters.from_level(
            3, strategy=zstandard.STRATEGY_LAZY, min_match=GRAM, search_log=6, hash_log=log, chain_log=log, window_log=log, write_content_size=False, write_dict_id=False)
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=params)
        made.append(zstandard.ZstdCompressor(dict_data=held, compression_params=params))
    return made


def savings(text: bytes, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Bytes that the toxic dictionary saves in each window of a plain text."""
    one, two = (c.compress for c in _compressors(ordinary, toxic))
    windows = (text[at : at + WINDOW] + TAIL for at in range(0, max(len(text) - HOP, 1) if text else 0, HOP))
    return np.fromiter((len(one(w)) - len(two(w)) for w in windows), np.int32)


def evidence(data: np.ndarray, offsets: np.ndarray, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Per text and threshold: log of the windows that save so much, and of their share; log of all windows."""
    k = len(THRESHOLDS)
    out = np.zeros((len(offsets) - 1, 2 * k + 1))
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        saved = np.sort(savings(_plain(data[a:b]), ordinary, toxic))
        reached = len(saved) - np.searchsorted(saved, THRESHOLDS)
        out[i] = *np.log1p(reached), *np.log((reached + 1) / (len(saved) + PRIOR)), np.log1p(len(saved))
    return out


class Model:
    """Two dictionaries and the calibration; `constant` where there is nothing to tell apart."""

    def __init__(self, texts: list[str], labels: np.ndarray, counts: dict):
        total = sum(counts.values())
        self.constant = counts.get(1, 0) / total if total else 0.0
        self.ordinary = self.toxic = b""
        self.weights, self.bias = np.zeros(2 * len(THRESHOLDS) + 1), 0.0
        if len(counts) < 2:
            return
        self.constant = None
        plain = [_plain(np.frombuffer(t.encode(), np.uint8)) for t in texts]
        held = np.array([zlib.crc32(t) % HELD == 0 for t in plain])  # copies of a text stay together
        if len(set(labels[held])) < 2 or len(set(labels[~held])) < 2:
            held = np.ones(len(plain), bool)  # hardly any texts: all serve both purposes
        learn = ~held if not held.all() else held
        self.ordinary, self.toxic = dictionaries(*(list(dict.fromkeys(t for t, l, u in zip(plain, labels, learn) if u and l == k)) for k in (1, 0)))
        data, y = [t for t, h in zip(plain, held) if h], labels[held].astype(float)
        x = evidence(np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in data], dtype=np.int64))), self.ordinary, self.toxic)
        self.weights, self.bias = logistic(x, y, steps=1500)
        self.bias += float(np.log((1 - y.mean()) / y.mean()))  # to classes of equal size
        self.bias -= max(0.0, float(np.quantile((x @ self.weights + self.bias)[y == 0], 1 - FALSE_ALARMS)))

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        return sigmoid(evidence(data, offsets, self.ordinary, self.toxic) @ self.weights + self.bias)


def fit(
    labelled: DataFrame, text: str = "text", label: str = "toxic", per_class: int = PER_CLASS, characters: int = CHARACTERS,
    labels: DataFrame | None = None, key: str = "doc_id",
) -> Model:
    """Model from rows with a text and a 0/1 label, which may stand in a table `labels` by `key`."""
    return Model(*class_sample(*as_labelled(labelled, text, label, key, labels), per_class, characters, *(() if labels is None else (as_labels(labels, label, key), key))))


def as_labelled(rows: DataFrame, text: str, label: str, key: str, labels: DataFrame | None):
    """Rows with the columns that `class_sample` reads, and their names."""
    own = F.col(text).alias("text")
    return rows.select(own, F.col(label).cast("int").alias("label")) if labels is None else rows.select(F.col(key), own), "text", "label"


def as_labels(labels: DataFrame, label: str, key: str) -> DataFrame:
    return labels.select(key, F.col(label).cast("int").alias("label"))


def scored(docs: DataFrame, model, text: str = "text", score: str = "score") -> DataFrame:
    """`docs` with the probability of label 1; any model with `score(bytes, offsets)`."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # dictionaries or weights of fixed size
    at = docs.columns.index(text)

    def add(batches):
        for batch in batches:
            data, offsets = flat(batch.column(at))
            scores = [held.value.score(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=[*batch.schema.names, score])

    return docs.mapInArrow(add, _with(docs, score))


def _with(docs: DataFrame, score: str):
    schema = type(docs.schema)(list(docs.schema.fields))
    return schema.add(score, "double")


def learning_rows(spark: SparkSession, sf_dir: str, label: str, parts: int, held_out: int) -> tuple[DataFrame, DataFrame]:
    """The documents, and the labels (doc_id, label) of those that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", label).filter(share_of("doc_id", parts) != held_out)
    return documents(spark, sf_dir).select("doc_id", "text"), labels


def scored_query(spark: SparkSession, sf_dir: str, model, parts: int, held_out: int) -> DataFrame:
    rows = scored(documents(spark, sf_dir).select("doc_id", "text"), model)
    return rows.select("doc_id", (share_of("doc_id", parts) == held_out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = learning_rows(spark, sf_dir, "toxic", 5, 0)
    model = fit(docs, labels=labels)
    return scored_query(spark, sf_dir, model, 5, 0)


QUERIES = {"op3_compression_toxicity": op3_compression_toxicity}
ORACLE: dict[str, str] = {}
