"""Language by interpolated Kneser-Ney character models in sorted hash arrays.

Per language a model of order `ORDER` is counted over lower-case letters, all else
being one space.  The highest order uses counts, lower orders the number of
different letters before (continuation counts); absolute discounting hands the
rest to the next lower order.  Grams of all languages share one sorted array of
64-bit hashes with a column of log probabilities per language; grams that no
language has seen are put together from the arrays of the lower orders.

The language with the lowest cross-entropy per character wins.  A text whose best
cross-entropy lies above `REJECT` standard deviations over the mean of the
language's own learning texts is marked as rejected.

Fitting uses at most `PER_LANGUAGE` texts a language with `CHARACTERS` characters
each, from all over the text, and at most 1000 languages.  Scoring reads whole texts.

Defined results: null texts and texts without a letter are `und` with score 0 and
rejected; without learning rows every text is `und`; repeated rows score alike; a
null language is no learning row; texts of any length are read whole; other columns are passed
on; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.llm.learning import class_sample
from headroom.llm.texts import U, documents, flat, mix, share_of, slices

ORDER = 4
PER_LANGUAGE = 1500
CHARACTERS = 4096
DISCOUNT = 0.75
REJECT = 4.0
SPACE = 32


@lru_cache(maxsize=1)
def folding() -> np.ndarray:
    """Code point -> lower-case letter, or a space."""
    table = np.full(0x110000, SPACE, np.uint32)
    for code in range(0x30000):  # planes with letters
        c = chr(code)
        if c.isalpha():
            table[code] = ord(c.lower()[0])
    return table


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters of texts, each text led by ORDER - 1 spaces, runs of spaces as one; n + 1 offsets."""
    wide = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begins = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]  # characters before each text
    folded = folding()[wide]
    blank = folded == SPACE
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    inner = begins[:-1][begins[:-1] < len(keep)]
    keep[inner] = ~blank[inner]
    before = np.concatenate(([0], np.cumsum(keep)))[begins]
    counts = np.diff(before)
    places = before + (ORDER - 1) * np.arange(len(begins))
    out = np.full(places[-1], SPACE, np.uint32)
    lead = np.repeat((ORDER - 1) * np.arange(1, len(begins)), counts)
    out[np.arange(keep.sum()) + lead] = folded[keep]
    return out, places


def grams(chars: np.ndarray, order: int) -> np.ndarray:
    """Hash of the `order` characters that end at each place (from place order - 1 on)."""
    n = len(chars) - order + 1
    key = np.full(max(n, 0), order, np.uint64)
    for k in range(order):
        key = (key + chars[k : n + k]) * U(0x9E3779B97F4A7C15)
        key ^= key >> U(32)
    return mix(key)


def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index in a sorted array (0 where absent) and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


class Model:
    """Languages, and per order: gram hashes with discounted shares, context hashes with the share handed down."""

    def __init__(self, texts: list[str], labels: np.ndarray):
        self.languages = sorted(set(labels.tolist()))
        many = len(self.languages)
        counted = []
        for language in self.languages:
            own = [t.encode() for t, l in zip(texts, labels) if l == language]
            chars, places = characters(np.frombuffer(b"".join(own), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in own]))))
            # Lines of ORDER characters ending at every letter or space of a text, counted.
            lines = np.lib.stride_tricks.sliding_window_view(chars, ORDER) if len(chars) >= ORDER else np.zeros((0, ORDER), np.uint32)
            inside = np.ones(len(lines), bool)
            inside[(places[1:-1, None] + np.arange(-ORDER + 1, 0)).ravel()] = False  # windows that cross into the next text's lead
            counted.append(self._counted(lines, inside))
        self.alphabet = max(1, len(np.unique(np.concatenate([c[0][:, -1] for c in counted]))) if counted else 1) + 1
        self.grams, self.shares, self.contexts, self.handed = {}, {}, {}, {}
        for order in range(ORDER, 0, -1):
            tables = []
            for number, (lines, counts) in enumerate(counted):
                ends = lines[:, ORDER - order :]
                if order < ORDER:  # distinct lines one longer, by their end
                    ends, counts = np.unique(np.unique(lines[:, ORDER - order - 1 :], axis=0)[:, 1:], axis=0, return_counts=True)
                tables.append((number, ends, counts))
            keys = np.unique(np.concatenate([self._hash(t[1]) for t in tables])) if tables else np.zeros(0, np.uint64)
            heads = np.unique(np.concatenate([self._hash(t[1][:, :-1]) for t in tables])) if tables else np.zeros(0, np.uint64)
            shares, handed = np.zeros((len(keys), many)), np.ones((len(heads), many))
            for number, ends, counts in tables:
                head = found(heads, self._hash(ends[:, :-1]))[0]
                total = np.bincount(head, counts, len(heads))
                kinds = np.bincount(head, minlength=len(heads))
                shares[found(keys, self._hash(ends))[0], number] = np.maximum(counts - DISCOUNT, 0) / total[head]
                handed[total > 0, number] = DISCOUNT * kinds[total > 0] / total[total > 0]
            self.grams[order], self.shares[order], self.contexts[order], self.handed[order] = keys, shares, heads, handed
        whole = [c[0] for c in counted]
        lines = np.unique(np.concatenate(whole), axis=0) if whole else np.zeros((0, ORDER), np.uint32)
        keys = self._hash(lines)
        order = np.argsort(keys)
        self.keys, self.logs = keys[order], self.log_probability(lines[order]).astype(np.float32)
        self.limits = np.full(many, np.inf)
        if many:
            data = [t.encode() for t in texts]
            whole, offsets = np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in data])))
            parts = [self.entropies(whole[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)]
            bits, size = (np.concatenate(x) for x in zip(*parts))
            for number, language in enumerate(self.languages):
                own = bits[(labels == language) & (size > 50), number]
                if len(own):
                    self.limits[number] = own.mean() + REJECT * own.std() + 0.1

    @staticmethod
    def _counted(lines: np.ndarray, inside: np.ndarray, step: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
        """Distinct lines and their counts, a range at a time."""
        found, counts = np.zeros((0, ORDER), np.uint32), np.zeros(0, np.int64)
        for a in range(0, len(lines), step):
            more, n = np.unique(lines[a : a + step][inside[a : a + step]], axis=0, return_counts=True)
            found, back = np.unique(np.concatenate((found, more)), axis=0, return_inverse=True)
            counts = np.bincount(back.ravel(), np.concatenate((counts, n)), len(found)).astype(np.int64)
        return found, counts

    @staticmethod
    def _hash(lines: np.ndarray) -> np.ndarray:
        """Hashes of equally long lines, as `grams` gives them."""
        key = np.full(len(lines), lines.shape[1], np.uint64)
        for k in range(lines.shape[1]):
            key = (key + lines[:, k]) * U(0x9E3779B97F4A7C15)
            key ^= key >> U(32)
        return mix(key)

    def log_probability(self, lines: np.ndarray) -> np.ndarray:
        """Natural log of the interpolated probability of each line's last character, a column per language."""
        p = np.full((len(lines), len(self.languages)), 1 / self.alphabet)
        for order in range(1, ORDER + 1):
            ends = lines[:, ORDER - order :]
            at, seen = found(self.contexts[order], self._hash(ends[:, :-1]))
            handed = np.where(seen[:, None], self.handed[order][at], 1.0) if len(self.contexts[order]) else 1.0
            at, seen = found(self.grams[order], self._hash(ends))
            share = np.where(seen[:, None], self.shares[order][at], 0.0) if len(self.grams[order]) else 0.0
            p = share + handed * p
        return np.log(p)

    def entropies(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (nats), texts by languages, and the texts' numbers of characters."""
        n, many = len(offsets) - 1, len(self.languages)
        chars, places = characters(data, offsets)
        size = np.diff(places) - (ORDER - 1)
        out = np.zeros((n, many))
        if len(chars) < ORDER or not many:
            return out, size
        key = grams(chars, ORDER)
        at, seen = found(self.keys, key)
        logs = self.logs[at]
        missing = np.flatnonzero(~seen)
        if len(missing):
            _, one, back = np.unique(key[missing], return_index=True, return_inverse=True)
            lines = np.lib.stride_tricks.sliding_window_view(chars, ORDER)[missing[one]]
            logs[missing] = self.log_probability(lines)[back]
        sums = np.zeros((len(logs) + 1, many))
        np.cumsum(logs, 0, out=sums[1:], dtype=np.float64)
        ends = np.minimum(places[:-1] + size, len(logs))  # a text's grams begin at its lead and end with its last character
        out = -(sums[ends] - sums[np.minimum(places[:-1], len(logs))]) / np.maximum(size, 1)[:, None]
        return out, size

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy in bits and whether it is rejected."""
        letters = np.diff(np.concatenate(([0], np.cumsum(self._letters(data))))[offsets])
        nats, size = self.entropies(data, offsets)
        if not self.languages:
            n = len(offsets) - 1
            return ["und"] * n, np.zeros(n), np.zeros(n), np.ones(n, bool)
        best = nats.argmin(1)
        least = nats.min(1)
        score = 1 / np.exp(np.clip((least[:, None] - nats) * np.minimum(size, 50)[:, None], -700, 0)).sum(1)
        none = letters == 0
        names = ["und" if x else self.languages[k] for x, k in zip(none, best)]
        return names, np.where(none, 0, score), np.where(none, 0, least / np.log(2)), none | (least > self.limits[best])

    @staticmethod
    def _letters(data: np.ndarray) -> np.ndarray:
        """1 at the first byte of each letter."""
        wide = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        out = np.zeros(len(data), np.int64)
        out[np.flatnonzero((data & 0xC0) != 0x80)] = folding()[wide] != SPACE
        return out


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, characters: int = CHARACTERS) -> Model:
    texts, labels, _ = class_sample(rows.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("label")), "text", "label", per_language, characters)
    return Model(texts, labels)


def identified(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, bits, rejected) for every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # size set by the bounded sample

    def add(batches):
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for a, b in slices(offsets):
                out = held.value.predict(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(x) for x in out)], names=[key, "lang_pred", "score", "bits", "rejected"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string").alias(text)).mapInArrow(add, f"`{key}` {kind}, lang_pred string, score double, bits double, rejected boolean")


def op4_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs.filter(share_of("doc_id", 4) != 2))
    return identified(docs, model).withColumn("held_out", share_of("doc_id", 4) == 2).select("doc_id", "held_out", "lang_pred", "score", "bits", "rejected")


QUERIES = {"op4_kneser_ney_language": op4_kneser_ney_language}
ORACLE: dict[str, str] = {}
