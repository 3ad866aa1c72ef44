"""Hard negatives by Fagin's threshold algorithm over blocks of candidates.

Every task packs its rows into blocks of at most `BLOCK` candidates; a block holds
its integer components and, per dimension, the candidates in sorted order, and is
written once.  For an anchor, sorted access runs down each dimension's list from
the end that its component's sign favours; candidates met for the first time are
scored by random access, as exact integers.  No unseen candidate can score above
the threshold, the sum of the components last met times the anchor's; access stops
once it is strictly below the k-th score kept so far, so that ties are never cut
off.  A look-up for positives keeps `POSITIVES` candidates of the anchor's label;
one for negatives keeps `NEGATIVES` per window of scores around a positive, and a
window is also done when the threshold falls below its lower end.  What a task
found in earlier blocks counts for later ones.  A block whose unseen rest is
small is scored to its end.

Anchors visit all blocks in rounds: a round's anchors, at most `ROUND` and therefore
bounded, are broadcast, blocks never move, and only each task's few best candidates
are shuffled.

Defined results: rows with a null label, vector or id, or with a null or non-finite
component take no part, nor do rows with a component of 2**27 or more after
scaling, whose scores could leave 64 bits; missing components of shorter vectors
count as 0; "other rows" are those of another id, and rows that share an id each
take part; a table without anchors, positives or rows gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headroom.llm.scratch import drop_stored, stored

BLOCK = 8192
ROUND = 16_384
POSITIVES = 5
NEGATIVES = 3
SCALE = 256.0
LIMIT = 1 << 27
LOW, HIGH = 50, 95  # percent of the positive's score between which a negative's lies
FIRST_DEPTH = 32
REST = 4  # a block whose unseen share is below 1 / REST is scored to its end

PACKED = "rows int, dims int, width int, ids binary, labels binary, components binary, lists binary"
_PACKED = pa.schema([("rows", pa.int32()), ("dims", pa.int32()), ("width", pa.int32()), *[(c, pa.binary()) for c in ("ids", "labels", "components", "lists")]])
NONE = np.zeros(0, np.int64)


def components(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, integer components) of the rows of (id, label, vector) that take part; shorter vectors end in zeros."""
    ids, labels, vectors = batch.column(0), batch.column(1), batch.column(2)
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    valid = pc.and_(pc.and_(ids.is_valid(), labels.is_valid()), vectors.is_valid()).to_numpy(zero_copy_only=False)
    values = vectors.flatten()
    numbers = values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(SCALE * numbers)
        good = np.isfinite(numbers) & values.is_valid().to_numpy(zero_copy_only=False) & (np.abs(scaled) < LIMIT)
    owner = np.repeat(np.arange(len(batch)), lengths)
    valid &= np.bincount(owner[~good], minlength=len(batch)) == 0
    out = np.zeros((len(batch), int(lengths.max(initial=0))), np.int64)
    out[owner[good], (np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths))[good]] = scaled[good].astype(np.int64)
    full = [pc.fill_null(c, 0).to_numpy(zero_copy_only=False).astype(np.int64)[valid] for c in (ids, labels)]
    return full[0], full[1], out[valid]


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    dims = max((p.shape[1] for p in parts), default=0)
    return np.concatenate([np.pad(p, ((0, 0), (0, dims - p.shape[1]))) for p in parts]) if parts else np.zeros((0, 0), np.int64)


def _pack(ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray, lists: bool = True) -> pa.RecordBatch:
    top = int(np.abs(matrix).max(initial=0))
    width = 2 if top < 1 << 15 else 4
    order = np.argsort(matrix, axis=0, kind="stable").T.astype(np.uint16 if len(ids) <= 1 << 16 else np.uint32) if lists else NONE
    row = [len(ids), matrix.shape[1], width, ids.tobytes(), labels.tobytes(), matrix.astype(f"i{width}").tobytes(), order.tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _PACKED)], schema=_PACKED)


def _blocks(size: int):
    def pack(batches):
        held, count = [], 0
        for batch in batches:
            part = components(batch)
            held.append(part)
            count += len(part[0])
            while count >= size:
                ids, labels, matrix = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), _stacked([h[2] for h in held])
                yield _pack(ids[:size], labels[:size], matrix[:size])
                held, count = [(ids[size:], labels[size:], matrix[size:])], count - size
        if count:
            yield _pack(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), _stacked([h[2] for h in held]))

    return pack


class Block:
    """Candidates with their sorted lists."""

    def __init__(self, row: dict):
        n, d = row["rows"], row["dims"]
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.matrix = np.frombuffer(row["components"], f"i{row['width']}").reshape(n, d)
        kind = np.uint16 if n <= 1 << 16 else np.uint32
        self.lists = np.frombuffer(row["lists"], kind).reshape(d, n) if row["lists"] else None
        self.size, self.dims, self.kinds = n, d, {}
        self.widest = np.abs(self.matrix.astype(np.int64)).max(axis=0) if n and d else np.zeros(d, np.int64)

    @functools.cached_property
    def ordered(self) -> np.ndarray:
        """Components of every dimension from the least to the greatest."""
        return np.take_along_axis(self.matrix.T, self.lists.astype(np.int64), axis=1).astype(np.int64)

    def _typed(self, kind: str) -> np.ndarray:
        if kind not in self.kinds:
            self.kinds[kind] = np.ascontiguousarray(self.matrix.astype(kind))
        return self.kinds[kind]

    def scores(self, chosen: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Inner products; floats are used where every partial sum is an exact integer in them."""
        bound = float(np.abs(anchor).astype(float) @ self.widest[: len(anchor)].astype(float))
        kind = "f4" if bound < 1 << 24 else "f8" if bound < 1 << 53 else "i8"
        matrix = self._typed(kind)[:, : len(anchor)]
        rows = matrix @ anchor.astype(kind) if 2 * len(chosen) > self.size else None
        return (rows[chosen] if rows is not None else matrix[chosen] @ anchor.astype(kind)).astype(np.int64)

    def descend(self, anchor: np.ndarray, wanted: np.ndarray, keep, done) -> int:
        """Threshold algorithm over the `wanted` candidates.

        `keep(positions, scores)` takes newly scored ones, `done(threshold)` says whether
        the rest can be left out.  Returns how many were scored.
        """
        anchor = anchor[: self.dims]
        used = np.flatnonzero(anchor)
        unseen, depth, scored = wanted.copy(), 0, 0
        if not len(used):
            chosen = np.flatnonzero(unseen)
            keep(chosen, np.zeros(len(chosen), np.int64))
            return len(chosen)
        down = anchor[used] > 0
        while depth < self.size:
            step = np.arange(depth, min(4 * depth or FIRST_DEPTH, self.size))
            places = np.where(down[:, None], self.size - 1 - step, step)
            met = np.zeros(self.size, bool)
            met[self.lists[used[:, None], places].ravel()] = True
            depth = int(step[-1]) + 1
            new = met & unseen
            unseen &= ~met
            left = int(unseen.sum())
            if left * REST < self.size:
                new |= unseen
                left = 0
            chosen = np.flatnonzero(new)
            scored += len(chosen)
            if len(chosen):
                keep(chosen, self.scores(chosen, anchor))
            if not left or done(int(anchor[used] @ self.ordered[used, places[:, -1]])):
                break
        return scored


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores with their ids; of equal scores the smaller ids first."""
    if len(scores) > 4 * k:
        at = scores >= np.partition(scores, -k)[-k]
        scores, ids = scores[at], ids[at]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def window(positive: int) -> tuple[int, int]:
    """Least and greatest score of a negative beside this positive."""
    return -(-LOW * positive // 100), HIGH * positive // 100


def _rows_of(batches):
    for batch in batches:
        yield from batch.to_pylist()


POSITIVE = "anchor int, id long, score long"
NEGATIVE = "anchor int, slot int, id long, score long"


def _find_positives(anchors, k: int):
    def find(batches):
        ids, labels, matrix = anchors.value
        kept = [(NONE, NONE)] * len(ids)
        for row in _rows_of(batches):
            block = Block(row)
            for i in range(len(ids)):

                def keep(chosen, scores):
                    s, c = kept[i]
                    kept[i] = best(np.concatenate((s, scores)), np.concatenate((c, block.ids[chosen])), k)

                block.descend(matrix[i], (block.labels == labels[i]) & (block.ids != ids[i]), keep, lambda bar: len(kept[i][0]) == k and bar < kept[i][0][-1])
        sizes = [len(s) for s, _ in kept]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(len(ids), dtype=np.int32), sizes)), pa.array(np.concatenate([c for _, c in kept])), pa.array(np.concatenate([s for s, _ in kept])),
        ], names=["anchor", "id", "score"])

    return find


def _find_negatives(anchors, k: int):
    def find(batches):
        ids, labels, matrix, positives = anchors.value  # positives: scores per anchor
        windows = [[window(int(p)) for p in own] for own in positives]
        kept = [[(NONE, NONE)] * len(own) for own in windows]
        for row in _rows_of(batches):
            block = Block(row)
            for i, own in enumerate(windows):
                open_ = [w for w in range(len(own)) if own[w][0] <= own[w][1]]
                if not open_:
                    continue
                low, high = min(own[w][0] for w in open_), max(own[w][1] for w in open_)

                def keep(chosen, scores):
                    inside = (scores >= low) & (scores <= high)
                    scores, found = scores[inside], block.ids[chosen[inside]]
                    for w in open_:
                        fits = (scores >= own[w][0]) & (scores <= own[w][1])
                        s, c = kept[i][w]
                        kept[i][w] = best(np.concatenate((s, scores[fits])), np.concatenate((c, found[fits])), k)

                def done(bar):
                    return all(bar < own[w][0] or (len(kept[i][w][0]) == k and bar < kept[i][w][0][-1]) for w in open_)

                block.descend(matrix[i], (block.labels != labels[i]) & (block.ids != ids[i]), keep, done)
        flat = [(i, w, *pair) for i, own in enumerate(kept) for w, pair in enumerate(own) if len(pair[0])]
        sizes = [len(x[2]) for x in flat]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.array([x[0] for x in flat], np.int32), sizes)), pa.array(np.repeat(np.array([x[1] for x in flat], np.int32), sizes)),
            pa.array(np.concatenate([NONE, *[x[3] for x in flat]])), pa.array(np.concatenate([NONE, *[x[2] for x in flat]])),
        ], names=["anchor", "slot", "id", "score"])

    return find


def _anchors_of(every: int):
    def take(batches):
        for row in _rows_of(batches):
            block = Block(row)
            at = block.ids % every == 0
            if at.any():
                yield _pack(block.ids[at], block.labels[at], block.matrix[at].astype(np.int64), lists=False)

    return take


def _rounds(packs: DataFrame, size: int):
    """Anchors in portions of at most `size`, read from the packs one partition at a time."""
    held, count = [], 0
    for row in packs.toLocalIterator():
        block = Block(row.asDict())
        part = (block.ids, block.labels, block.matrix.astype(np.int64))
        while len(part[0]):
            take = min(size - count, len(part[0]))
            held.append(tuple(x[:take] for x in part))
            part, count = tuple(x[take:] for x in part), count + take
            if count == size:
                yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), _stacked([h[2] for h in held])
                held, count = [], 0
    if held:
        yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), _stacked([h[2] for h in held])


def _top(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding", every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES,
    block: int = BLOCK, round_size: int = ROUND,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): per anchor (ids divisible by `every`) and
    each of its nearest rows of the same label, the highest-scoring rows of other labels within the window of that positive."""
    spark = vectors.sparkSession
    own = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    blocks = stored(own.mapInArrow(_blocks(block), PACKED), "blocks")
    packs = stored(blocks.mapInArrow(_anchors_of(every), PACKED), "anchors")
    results = []
    for ids, labels, matrix in _rounds(packs, round_size):
        shared = spark.sparkContext.broadcast((ids, labels, matrix))
        found = _top(blocks.mapInArrow(_find_positives(shared, positives), POSITIVE), ["anchor"], positives).toArrow().sort_by([("anchor", "ascending"), ("rank", "ascending")])
        cuts = np.searchsorted(found["anchor"].to_numpy(), np.arange(len(ids) + 1))
        chosen, scores = found["id"].to_numpy(), found["score"].to_numpy()
        per_anchor = [scores[a:b] for a, b in zip(cuts, cuts[1:])]
        windows = spark.sparkContext.broadcast((ids, labels, matrix, per_anchor))
        ranked = _top(blocks.mapInArrow(_find_negatives(windows, negatives), NEGATIVE), ["anchor", "slot"], negatives)
        named = spark.sparkContext.broadcast((ids, cuts, chosen, scores))
        results.append(stored(ranked.select("anchor", "slot", "rank", "id", "score").mapInArrow(_named(named), RESULT), "negatives"))
        for held in (shared, windows, named):
            held.unpersist()
    for table in (blocks, packs):
        drop_stored(table)
    return functools.reduce(DataFrame.unionAll, results) if results else spark.createDataFrame([], RESULT)


def _named(names):
    def name(batches):
        ids, cuts, chosen, scores = names.value
        for batch in batches:
            anchor, slot = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            at = cuts[anchor] + slot
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[anchor]), pa.array(chosen[at]), batch.column(2), batch.column(3), pa.array(scores[at]), batch.column(4)],
                names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return name


def op13_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", moved.alias("label"), "embedding"))


QUERIES = {"op13_threshold_negatives": op13_threshold_negatives}
ORACLE = {"op13_threshold_negatives": """with v as (select vec_id, case when vec_id%7=0 then (label+1)%10 else label end label, list_transform(embedding, lambda x: floor(256*x::double)) e
 from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x)))=0),
 a as (select * from v where vec_id%50=0),
 s as (select a.vec_id anchor_id, v.vec_id other, a.label=v.label same, list_dot_product(a.e, v.e)::bigint score from a join v on a.vec_id<>v.vec_id),
 p as (select * from (select *, row_number() over (partition by anchor_id order by score desc, other) k from s where same) where k<=5),
 n as (select p.anchor_id, p.other positive_id, s.other negative_id, p.score positive_score, s.score negative_score,
  row_number() over (partition by p.anchor_id, p.other order by s.score desc, s.other) r from p join s on p.anchor_id=s.anchor_id and not s.same and 50*p.score<=100*s.score and 100*s.score<=95*p.score)
select anchor_id, positive_id, r::int "rank", negative_id, positive_score, negative_score from n where r<=3"""}
