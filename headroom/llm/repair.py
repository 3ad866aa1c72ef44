"""Conversation repair: the cheapest edits that make the roles read `(s?(ua)+)?`, by block tables (`fourrussians`).

Equal rows are counted first.  Rows are then dealt by range of (conversation,
turn, role, text), so that a long conversation is spread over many tasks, and
read in order.  A conversation that lies within one task is repaired there.  What
a task's border or `CHUNK` rows cut into pieces is repaired in three steps, none of
which gathers its texts: each piece becomes a small function of what follows it
(`summary`), the functions of a conversation are put together from its end and
then from its start, and each piece is traced from the state and vector it was
given.  Repetitions across pieces are found by 128-bit digests before that.

Defined results: conversations are told apart by id, and a null id is one of
them; null roles and texts are one space; rows of one turn are ordered by role and
text, null turns first; a row is blank, else a duplicate, else truncated; unknown
and empty roles fit nowhere and can only be renamed or deleted; a conversation
without rows has zeros, no edits and the digest of an empty text; texts of any
length are read whole; other columns are ignored, whatever their names; an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.llm import fourrussians as fr
from headroom.llm.scratch import stored

CHUNK = 4096
CHUNK_BYTES = 4 << 20
WHITE = b" \t\n\x0b\x0c\r"

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
KEY = [("none", pa.bool_()), ("conv", pa.int64()), ("part", pa.int32()), ("chunk", pa.int32())]
TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_DONE = [(c, pa.int64()) for c in COUNTS] + [("audit", pa.string()), ("sha256", pa.string()), ("turns", TURNS)]
_RAW = [("turn", pa.list_(pa.int64())), ("role", pa.list_(pa.string())), ("text", pa.list_(pa.string())), ("copies", pa.list_(pa.int64()))]
PIECE = pa.schema([*KEY, ("whole", pa.bool_()), *_DONE, *_RAW])
SUMMARY = pa.schema([*KEY, ("front", pa.binary()), ("added", pa.binary()), ("leaves", pa.binary()), *[(c, pa.int64()) for c in COUNTS[:-1]],
                     ("rows", pa.int64()), ("first_role", pa.string()), ("last_role", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64())])
PLACE = pa.schema([*KEY, ("vector", pa.int32()), ("state", pa.int32()), ("last", pa.bool_()), *[(c, pa.int64()) for c in COUNTS]])
TRACED = pa.schema([*KEY, *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("body", pa.binary()), ("turns", TURNS)])


def _ddl(schema: pa.Schema) -> str:
    from pyspark.sql.pandas.types import from_arrow_schema

    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in from_arrow_schema(schema))


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


def digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(role.encode() + b"\0" + text.encode(), digest_size=16).digest()


class Piece:
    """Consecutive rows of a conversation: (turn, role, text, copies) with copies >= 1; faults are found on reading."""

    def __init__(self, rows: list[tuple], seen: set[bytes] | None = None):
        """`seen`: digests of role and text that earlier pieces hold."""
        self.rows, seen = rows, set() if seen is None else seen
        self.blank = self.duplicate = self.truncated = 0
        signs = []
        for _, role, text, copies in rows:
            body = text.encode().strip(WHITE)
            mark = digest(role, text)
            if not body:
                self.blank += copies
                signs.append((fr.GONE, copies))
                continue
            again = mark in seen
            seen.add(mark)
            self.duplicate += copies - (not again)
            if again:
                signs.append((fr.GONE, copies))
                continue
            cut = body[-1] not in b".!?"
            self.truncated += cut
            signs.append((fr.symbol(role[:1], cut), 1))
            if copies > 1:
                signs.append((fr.GONE, copies - 1))
        self.signs = np.repeat(np.array([s for s, _ in signs], np.int64), np.array([n for _, n in signs], np.int64))
        self.owner = np.repeat(np.arange(len(rows)), np.array([r[3] for r in rows], np.int64))
        initials = [r[1][:1] for r in rows]
        pairs = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        self.illegal = pairs + sum(r[3] - 1 for r in rows)
        known = sorted({r[0] for r in rows if r[0] is not None})
        self.first_turn, self.last_turn, self.turns = (known[0], known[-1], len(known)) if known else (None, None, 0)

    def counts(self) -> dict[str, int]:
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}

    def edits(self, vector: int = 0, state: int = fr.START, last: bool = True):
        """(cost added, audit, repaired turns) given the vector behind the piece and the state in front of it."""
        front, behind, added = fr.cost_of(self.signs, vector)
        letters, end = fr.traced(self.signs, behind, state)
        turns = []
        for at, edit in zip(self.owner.tolist(), letters):
            new, state = fr.written(edit, self.rows[at][1], self.rows[at][2], state)
            turns += new
        audit = "".join(letters)
        if last:
            new, _ = fr.written(fr.ending(end), "", "", end)
            audit, turns = audit + fr.ending(end), turns + new
        return added + fr.tables().vectors[front][fr.START], audit, turns


def _body(turns: list[tuple[str, str]]) -> bytes:
    return b"\n".join(f"{role}:{text}".encode() for role, text in turns)


def _read(with_turns: bool, chunk: int):
    """Sorted rows -> finished conversations and, of those that may go on in other tasks or are long, raw pieces."""

    def rows_of(batches):
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))

    def read(batches):
        part, out, held = TaskContext.get().partitionId(), [], 0

        def raw(key, number, rows):
            return {"none": key[0], "conv": key[1], "part": part, "chunk": number, "whole": False,
                    "turn": [r[0] for r in rows], "role": [r[1] for r in rows], "text": [r[2] for r in rows], "copies": [r[3] for r in rows]}

        def finished(key, rows):
            piece = Piece(rows)
            cost, audit, turns = piece.edits()
            return {"none": key[0], "conv": key[1], "part": part, "chunk": 0, "whole": True, **piece.counts(), "cost": cost, "audit": audit,
                    "sha256": hashlib.sha256(_body(turns)).hexdigest(), "turns": [{"role": r, "text": t} for r, t in turns] if with_turns else None}

        key, rows, size, number, begun = None, [], 0, 0, 0
        for none, conv, turn, role, text, copies in rows_of(batches):
            if (none, conv) != key:
                if key is not None:
                    # the first conversation of a task may have begun in another one
                    out.append(raw(key, number, rows) if number or begun == 1 else finished(key, rows))
                key, rows, size, number, begun = (none, conv), [], 0, 0, begun + 1
            elif len(rows) >= chunk or size >= CHUNK_BYTES:
                out.append(raw(key, number, rows))
                rows, size, number = [], 0, number + 1
            if copies:
                rows.append((turn, role, text, copies))
                size += len(text)
            held += len(text)
            if held >= CHUNK_BYTES or len(out) >= 2000:
                yield from _table(out, PIECE).to_batches()
                out, held = [], 0
        if key is not None:
            out.append(raw(key, number, rows))
        yield from _table(out, PIECE).to_batches()

    return read


def _piece(table: pa.Table, row: int, seen=None) -> Piece:
    columns = [table[c][row].as_py() for c in ("turn", "role", "text", "copies")]
    return Piece(list(zip(*columns)), seen)


def _key(table: pa.Table, row: int) -> dict:
    return {name: table[name][row].as_py() for name, _ in KEY}


def _digests(batches):
    """(none, conv, part, chunk, digest) of every different row of a piece."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for row in range(len(table)):
            marks = {digest(r, t) for r, t in zip(table["role"][row].as_py(), table["text"][row].as_py())}
            key = _key(table, row)
            yield from _table([{**key, "mark": m} for m in marks], pa.schema([*KEY, ("mark", pa.binary())])).to_batches()


def _summaries(batches):
    for batch in batches:
        table, out = pa.Table.from_batches([batch]), []
        for row in range(len(table)):
            piece = _piece(table, row, set(table["seen"][row].as_py() or ()))
            front, added, leaves = fr.summary(piece.signs)
            out.append({**_key(table, row), "front": front.astype(np.int32).tobytes(), "added": added.astype(np.int64).tobytes(), "leaves": leaves.tobytes(),
                        **piece.counts(), "rows": len(piece.signs), "first_role": piece.rows[0][1][:1] if piece.rows else None,
                        "last_role": piece.rows[-1][1][:1] if piece.rows else None, "first_turn": piece.first_turn, "last_turn": piece.last_turn, "turns": piece.turns})
        yield from _table(out, SUMMARY).to_batches()


def _placed(table: pa.Table) -> pa.Table:
    """The pieces of a conversation put together: vector behind and state in front of each, and the conversation's counts."""
    pieces = sorted(table.to_pylist(), key=lambda r: (r["part"], r["chunk"]))
    vector, total, behind = 0, 0, []
    for p in reversed(pieces):
        behind.insert(0, vector)
        total += int(np.frombuffer(p["added"], np.int64)[vector])
        vector = int(np.frombuffer(p["front"], np.int32)[vector])
    cost = total + fr.tables().vectors[vector][fr.START]
    full = [p for p in pieces if p["rows"]]
    counts = {c: sum(p[c] for p in pieces) for c in ("blank", "duplicate", "truncated", "illegal")}
    counts["illegal"] += sum(a["last_role"] + b["first_role"] not in ("su", "ua", "au") for a, b in zip(full, full[1:]))
    timed = [p for p in full if p["turns"]]
    shared = sum(a["last_turn"] == b["first_turn"] for a, b in zip(timed, timed[1:]))
    counts["gaps"] = timed[-1]["last_turn"] - timed[0]["first_turn"] + 1 - sum(p["turns"] for p in timed) + shared if timed else 0
    state, out = fr.START, []
    for p, after in zip(pieces, behind):
        out.append({**{k: p[k] for k, _ in KEY}, "vector": after, "state": state, "last": p is pieces[-1], **counts, "cost": cost})
        state = int(np.frombuffer(p["leaves"], np.uint8).reshape(-1, 4)[after, state])
    return _table(out, PLACE)


def _traces(with_turns: bool):
    def trace(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for row in range(len(table)):
                piece = _piece(table, row, set(table["seen"][row].as_py() or ()))
                _, audit, turns = piece.edits(table["vector"][row].as_py(), table["state"][row].as_py(), table["last"][row].as_py())
                one = {**_key(table, row), **{c: table[c][row].as_py() for c in COUNTS}, "audit": audit, "body": _body(turns) if turns else None,
                       "turns": [{"role": r, "text": t} for r, t in turns] if with_turns else None}
                yield from _table([one], TRACED).to_batches()

    return trace


DIGEST = pa.schema([("none", pa.bool_()), ("conv", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("sha256", pa.string())])


def _hashed(batches):
    """Pieces in order -> a digest row per conversation; texts are hashed as they come, none is held."""
    row, edits, sha, begun = None, [], None, False
    for batch in batches:
        for piece in batch.to_pylist():
            if row is None or (row["none"], row["conv"]) != (piece["none"], piece["conv"]):
                if row is not None:
                    yield from _table([{**row, "audit": "".join(edits), "sha256": sha.hexdigest()}], DIGEST).to_batches()
                row, edits, sha, begun = {c: piece[c] for c in ("none", "conv", *COUNTS)}, [], hashlib.sha256(), False
            edits.append(piece["audit"])
            if piece["body"] is not None:
                sha.update((b"\n" if begun else b"") + piece["body"])
                begun = True
    if row is not None:
        yield from _table([{**row, "audit": "".join(edits), "sha256": sha.hexdigest()}], DIGEST).to_batches()


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None,
             chunk: int = CHUNK, with_turns: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """(digest, turns) of the conversations of `rows`.

    digest: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    turns (if `with_turns`): conv_id, part, chunk and the repaired turns of that piece, an array of role and text.
    `copies` names a column with the number of times a row stands; 0 only makes its conversation known.
    """
    times = F.lit(1) if copies is None else F.col(copies)
    space = F.lit(" ")
    plain = rows.select(
        F.col(conv).isNull().alias("none"), F.coalesce(F.col(conv).cast("long"), F.lit(0)).alias("conv"), times.cast("long").alias("copies"),
        F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), space).alias("role"), F.coalesce(F.col(text).cast("string"), space).alias("text"))
    gone = F.col("copies") == 0
    plain = plain.withColumns({"turn": F.when(~gone, F.col("turn")), "role": F.when(gone, "").otherwise(F.col("role")), "text": F.when(gone, "").otherwise(F.col("text"))})
    counted = plain.groupBy("none", "conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    order = ["none", "conv", "turn", "role"]
    dealt = counted.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    pieces = stored(dealt.select(*order, "text", "copies").mapInArrow(_read(with_turns, chunk), _ddl(PIECE)), "pieces")
    whole = pieces.filter("whole")
    key = [name for name, _ in KEY]
    cut = pieces.filter("not whole").select(*key, *[name for name, _ in _RAW])
    marks = cut.mapInArrow(_digests, _ddl(pa.schema([*KEY, ("mark", pa.binary())])))
    first = marks.groupBy("none", "conv", "mark").agg(F.min(F.struct("part", "chunk")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    later = marks.join(first, ["none", "conv", "mark"]).filter(F.struct("part", "chunk") > F.col("first"))
    known = later.groupBy(*key).agg(F.collect_list("mark").alias("seen"))  # at most the rows of a piece
    cut = stored(cut.join(known, key, "left"), "cut")
    summed = cut.mapInArrow(_summaries, _ddl(SUMMARY))
    placed = summed.groupBy("none", "conv").applyInArrow(_placed, _ddl(PLACE))
    traced = stored(cut.join(placed, key).mapInArrow(_traces(with_turns), _ddl(TRACED)), "traced")
    in_order = traced.drop("turns").repartition("none", "conv").sortWithinPartitions(*key)
    digests = whole.select("none", "conv", *COUNTS, "audit", "sha256").unionByName(in_order.mapInArrow(_hashed, _ddl(DIGEST)))
    name = F.when(~F.col("none"), F.col("conv")).alias("conv_id")
    digest = digests.select(name, *COUNTS, "audit", F.col("sha256").alias("repaired_sha256"))
    if not with_turns:
        return digest, None
    return digest, whole.select(*key, "turns").unionByName(traced.select(*key, "turns")).select(name, "part", "chunk", "turns")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by a checksum of id and turn; `copies` is 0 for a dropped row and 2 for a repeated one."""
    space = F.lit(" ")
    part = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    role, text = F.coalesce(F.col("role"), space), F.coalesce(F.col("text"), space)
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def op12_block_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return repaired(rows, copies="copies", with_turns=False)[0]


QUERIES = {"op12_block_repair": op12_block_repair}
ORACLE: dict[str, str] = {}
