"""Quality probability by a byte-level convolutional network, fitted and run in numpy.

A text is cut into blocks of `BLOCK` bytes; two neighbouring blocks are a chunk, so
chunks overlap by half and cover the whole document.  Learned filters slide over
embedded bytes; each chunk keeps every filter's greatest response, a hidden layer
judges the chunk from these (also from what is absent, as in word repeats), and the
greatest and the mean response over all chunks give one probability.

Fitting uses at most `PER_CLASS` labelled texts a class with `CHARACTERS` characters
each, from all over the text, on the driver; the network has some 6,000 numbers.
Scoring reads whole texts, block range by block range, so that a very long text
needs little memory.

Defined results: null and empty texts are one chunk of padding and get its score;
without labels of both classes every score is the share of label 1 (0 without
labels); repeated rows score alike; a null label is no label; texts of any
length are read whole, in chunks; other columns are passed on, an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.llm.learning import class_sample, sigmoid
from headroom.llm.toxicity import as_labelled, as_labels, learning_rows, scored_query

PER_CLASS = 2500
CHARACTERS = 4096
BLOCK, WIDTH, DEPTH, FILTERS, HIDDEN = 128, 12, 8, 32, 24
EPOCHS, BATCH = 8, 32
RANGE = 4096  # blocks scored at once


class Network:
    def __init__(self, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.p = {
            "byte": draw.normal(0, 1, (256, DEPTH)), "filter": draw.normal(0, 0.1, (WIDTH * DEPTH, FILTERS)), "shift": np.zeros(FILTERS),
            "hidden": draw.normal(0, 0.2, (FILTERS, HIDDEN)), "offset": np.zeros(HIDDEN), "out": draw.normal(0, 0.2, 2 * HIDDEN), "bias": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.prior = 0.0

    @staticmethod
    def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of all texts (zeros behind each text) and the n + 1 block offsets; at least two blocks a text."""
        sizes = np.diff(offsets)
        many = np.maximum(2, -(-(sizes + WIDTH) // BLOCK))
        blocks = np.concatenate(([0], np.cumsum(many)))
        out = np.zeros(blocks[-1] * BLOCK + WIDTH, np.uint8)
        shift = blocks[:-1] * BLOCK - offsets[:-1]
        out[np.arange(len(data)) + np.repeat(shift, sizes)] = data
        return out, blocks

    def responses(self, padded: np.ndarray, blocks: int) -> np.ndarray:
        """Filter responses at every second byte: (blocks, BLOCK / 2, FILTERS)."""
        pairs = self.p["byte"][padded[: blocks * BLOCK + WIDTH]].reshape(-1, 2 * DEPTH)
        n, steps = blocks * BLOCK // 2, WIDTH // 2
        kernel = self.p["filter"].reshape(steps, 2 * DEPTH, FILTERS)
        out = pairs[:n] @ kernel[0]
        for k in range(1, steps):
            out += pairs[k : n + k] @ kernel[k]
        return out.reshape(blocks, BLOCK // 2, FILTERS)

    def peaks(self, padded: np.ndarray, blocks: int) -> np.ndarray:
        """Greatest response of each filter in each block, in ranges of bounded size."""
        parts = [self.responses(padded[a * BLOCK :], min(RANGE, blocks - a)).max(1) for a in range(0, blocks, RANGE)]
        return np.concatenate(parts)

    def judged(self, peak: np.ndarray):
        """Pooled responses and hidden values of chunks, from the blocks' peaks of one run of texts."""
        pooled = np.maximum(peak + self.p["shift"], 0)
        return pooled, np.maximum(pooled @ self.p["hidden"] + self.p["offset"], 0)

    def chunk_of(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First block of each chunk and the n + 1 chunk offsets."""
        first = np.ones(blocks[-1], bool)
        first[blocks[1:] - 1] = False
        return np.flatnonzero(first), blocks - np.arange(len(blocks))

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        padded, blocks = self.padded(data, offsets)
        peak = self.peaks(padded, int(blocks[-1]))
        at, chunks = self.chunk_of(blocks)
        _, hidden = self.judged(np.maximum(peak[at], peak[at + 1]))
        whole = np.concatenate((np.maximum.reduceat(hidden, chunks[:-1]), np.add.reduceat(hidden, chunks[:-1]) / np.diff(chunks)[:, None]), 1)
        return sigmoid(whole.astype(float) @ self.p["out"] + self.p["bias"][0] + self.prior)

    def gradients(self, data: np.ndarray, offsets: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss; maxima pass theirs to where they were taken."""
        p, (padded, blocks) = self.p, self.padded(data, offsets)
        responses = self.responses(padded, int(blocks[-1]))
        spot = responses.argmax(1)
        peak = np.take_along_axis(responses, spot[:, None], 1)[:, 0]
        at, chunks = self.chunk_of(blocks)
        right = peak[at + 1] > peak[at]
        pooled, hidden = self.judged(np.where(right, peak[at + 1], peak[at]))
        text = np.repeat(np.arange(len(y)), np.diff(chunks))
        top, mean = np.maximum.reduceat(hidden, chunks[:-1]), np.add.reduceat(hidden, chunks[:-1]) / np.diff(chunks)[:, None]
        whole = np.concatenate((top, mean), 1)
        slope = ((sigmoid(whole @ p["out"] + p["bias"][0]) - y) / len(y)).astype(np.float32)
        g = {"out": whole.T @ slope, "bias": slope.sum(keepdims=True)}
        is_top = (hidden == top[text]).astype(np.float32)
        is_top /= np.maximum(np.add.reduceat(is_top, chunks[:-1])[text], 1)
        each = slope[text, None] * (is_top * p["out"][:HIDDEN] + p["out"][HIDDEN:] / np.diff(chunks)[text][:, None]) * (hidden > 0)
        g["hidden"], g["offset"] = pooled.T @ each, each.sum(0)
        back = (each @ p["hidden"].T) * (pooled > 0)
        g["shift"] = back.sum(0)
        block = np.where(right, at[:, None] + 1, at[:, None])
        place = block * BLOCK + 2 * spot[block, np.arange(FILTERS)]
        g["filter"], g["byte"] = np.zeros_like(p["filter"]), np.zeros_like(p["byte"])
        for f in range(FILTERS):
            used = np.flatnonzero(back[:, f])
            seen = padded[place[used, f][:, None] + np.arange(WIDTH)]
            g["filter"][:, f] = p["byte"][seen].reshape(len(used), -1).T @ back[used, f]
            change = back[used, f][:, None, None] * p["filter"][:, f].reshape(WIDTH, DEPTH)
            for d in range(DEPTH):
                g["byte"][:, d] += np.bincount(seen.ravel(), change[:, :, d].ravel(), 256)
        return g

    def fit(self, texts: list[bytes], y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.004) -> "Network":
        draw, step = np.random.default_rng(2), 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        total = epochs * max(1, len(texts) // BATCH)
        for _ in range(epochs):
            order = draw.permutation(len(texts))
            for a in range(0, len(order) - BATCH // 2, BATCH):
                chosen = [texts[i] for i in order[a : a + BATCH]]
                data = np.frombuffer(b"".join(chosen), np.uint8)
                g = self.gradients(data, np.concatenate(([0], np.cumsum([len(t) for t in chosen]))), y[order[a : a + BATCH]])
                step += 1
                now = rate * max(0.05, 1 - step / total)
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    self.p[k] = (self.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
        return self


class Constant:
    def __init__(self, share: float):
        self.share = share

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.full(len(offsets) - 1, self.share)


def fit(
    labelled: DataFrame, text: str = "text", label: str = "quality", per_class: int = PER_CLASS, characters: int = CHARACTERS, epochs: int = EPOCHS,
    labels: DataFrame | None = None, key: str = "doc_id",
):
    """Model with `score` from rows with a text and a 0/1 label, which may stand in a table `labels` by `key`; classes are weighed back to their shares."""
    known = () if labels is None else (as_labels(labels, label, key), key)
    texts, labels, counts = class_sample(*as_labelled(labelled, text, label, key, labels), per_class, characters, *known)
    if len(counts) < 2:
        total = sum(counts.values())
        return Constant(counts.get(1, 0) / total if total else 0.0)
    network = Network().fit([t.encode() for t in texts], labels.astype(np.float32), epochs)
    network.prior = float(np.log(counts[1] / counts[0]) - np.log((labels == 1).sum() / (labels == 0).sum()))
    return network


def op2_byte_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = learning_rows(spark, sf_dir, "quality", 3, 1)
    return scored_query(spark, sf_dir, fit(docs, labels=labels), 3, 1)


QUERIES = {"op2_byte_convolution": op2_byte_convolution}
ORACLE: dict[str, str] = {}
