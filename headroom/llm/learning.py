"""Bounded, repeatable samples of labelled rows for fitting classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headroom.llm.scratch import stored

PIECE = 512


def pieces_of(text: Column, limit: int) -> Column:
    """The whole text, or evenly spaced pieces from its start to its end that make up `limit` characters."""
    n, count = F.length(text), limit // PIECE
    parts = [text.substr((F.lit(1) + F.floor((n - PIECE) * i / (count - 1))).cast("int"), F.lit(PIECE)) for i in range(count)]
    return F.when(n <= limit, text).otherwise(F.concat(*parts))


SPARE = 1.3  # drawn texts to one that is kept, and `MORE` besides, so that a draw leaves hardly ever too few
MORE = 50
BITS = 1 << 52


def _limit(groups: list[tuple[int, int]], wanted: float) -> float:
    """Limit of -log(u) / copies below which about `wanted` texts lie; groups are (rows, texts) of texts with like numbers of copies."""
    if sum(texts for _, texts in groups) <= wanted:
        return float("inf")
    low, high = -60.0, 60.0
    for _ in range(80):
        middle = (low + high) / 2
        below = sum(texts * -np.expm1(-rows / texts * np.exp(middle)) for rows, texts in groups)
        low, high = (middle, high) if below < wanted else (low, middle)
    return float(np.exp(high))


def class_sample(
    rows: DataFrame, text: str, label: str, per_class: int, characters: int, labels: DataFrame | None = None, key: str = "doc_id",
) -> tuple[list[str], np.ndarray, dict]:
    """(texts, labels, rows of each class) of at most `per_class` rows a class; null labels are left out.

    `labels`, where given, is a table of `key` and `label` for the rows; it meets their
    keys and two hashes of their texts only, and the drawn texts are fetched by these
    hashes, so that no text is shuffled before the draw at any size.

    Distinct texts are drawn by a hash with their numbers of copies as weights, about
    SPARE * `per_class` a class, before a text is fetched; a text is fetched once.  The
    rows given stand for all rows of the class: a text is repeated by its share of
    them, and all rows are given where they fit.  Each text counts with at most
    `characters` characters taken from all over it.
    """
    keys = ["label", "h", "g"]
    own = F.coalesce(F.col(text), F.lit(""))
    marks = {"h": F.xxhash64("text", F.lit(17)), "g": F.xxhash64("text", F.lit(71))}
    if labels is None:
        marked = rows.filter(F.col(label).isNotNull()).select(own.alias("text"), F.col(label).alias("label")).withColumns(marks)
        seen, found_by = marked, keys
    else:
        marked = rows.select(F.col(key).alias("key"), own.alias("text")).withColumns(marks)
        known = labels.filter(F.col(label).isNotNull()).select(F.col(key).alias("key"), F.col(label).alias("label"))
        seen, found_by = marked.select("key", "h", "g").join(known, "key"), ["h", "g"]
    kinds = stored(seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "kinds")
    sizes = kinds.groupBy("label", F.floor(F.log2("n")).alias("like")).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("texts")).collect()
    if not sizes:
        return [], np.array([]), {}
    groups: dict = {}
    for r in sizes:
        groups.setdefault(r.label, []).append((r.rows, r.texts))
    counts = {k: sum(n for n, _ in g) for k, g in groups.items()}
    wanted = SPARE * per_class + MORE
    limits = {k: _limit(sorted(g), wanted) for k, g in groups.items()}
    schema = type(kinds.schema)([kinds.schema["label"]]).add("limit", "double")
    limited = kinds.sparkSession.createDataFrame(list(limits.items()), schema)
    turn = -F.log((F.pmod("h", F.lit(BITS)) + 1) / float(BITS)) / F.col("n")
    chosen = kinds.join(limited, "label").withColumn("turn", turn).filter("turn < limit").drop("limit")
    if sum(min(wanted, sum(t for _, t in g)) for g in groups.values()) < BROADCAST:
        chosen = F.broadcast(chosen)
    fetched = marked.join(chosen, found_by).select(*keys, "n", "turn", pieces_of(F.col("text"), characters).alias("text"))
    found = fetched.groupBy(*keys).agg(F.first("n").alias("n"), F.first("turn").alias("turn"), F.first("text").alias("text")).toArrow()
    own, n, turn = np.array(found["label"].to_pylist()), found["n"].to_numpy(), found["turn"].to_numpy()
    pieces, texts, labels = found["text"].to_pylist(), [], []
    for k in sorted(counts):
        at = np.flatnonzero(own == k)
        at, limit = at[np.argsort(turn[at], kind="stable")], limits[k]
        if len(at) > per_class:
            at, limit = at[:per_class], turn[at[per_class]]
        weight = n[at] / -np.expm1(-n[at] * limit)  # rows that the text stands for
        order = sorted(range(len(at)), key=lambda i: pieces[at[i]])
        edges = np.floor(np.cumsum(weight[order]) / weight.sum() * min(per_class, counts[k]) + 0.5).astype(int)
        for i, copies in zip(order, np.diff(edges, prepend=0)):
            texts += [pieces[at[i]]] * copies
            labels += [k] * copies
    return texts, np.array(labels), counts


#: Drawn texts are broadcast by their hashes up to this number (some 40 MB) and joined by shuffle beyond it.
BROADCAST = 1_000_000


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.1, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on standardised columns, by Adam."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w, m, v = np.zeros(z.shape[1]), 0.0, 0.0
    for t in range(1, steps + 1):
        g = z.T @ (1 / (1 + np.exp(-np.clip(z @ w, -30, 30))) - y) / len(y) + decay * np.r_[w[:-1], 0]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ mean)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
