import hashlib
import heapq
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from headroom.llm import fourrussians as fr
from headroom.llm import repair

WHITE = re.compile("[^\x20\x09-\x0d]")
GOOD = re.compile(r"\A(s?(ua)+)?\Z")


def cheapest(rows):
    """Uniform-cost search over (row, state, text): the least (cost, audit) with the repaired turns.  rows: (role, text, must go, cut off)."""
    heap, done, n = [(0, "", 0, "", ())], {}, len(rows)
    best = None
    while heap:
        cost, audit, at, roles, turns = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        state = roles[-1:] or "-"
        if at == n and GOOD.match(roles):
            best = min(best, (cost, audit, turns)) if best else (cost, audit, turns)
        if done.get((at, state), 10**9) < cost:
            continue
        done[at, state] = cost
        follows = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[follows]
        heapq.heappush(heap, (cost + 5, audit + "I", at, roles + follows, turns + ((name, ""),)))
        if at < n:
            role, text, gone, cut = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, roles, turns))
            if not gone:
                heapq.heappush(heap, (cost + 1 + 5 * cut, audit + "R", at + 1, roles + follows, turns + ((name, text),)))
                if role[:1] == follows or (role[:1] == "s" and not roles):
                    heapq.heappush(heap, (cost + 5 * cut, audit + "K", at + 1, roles + role[:1], turns + ((role, text),)))
    return best


def plain(rows):
    """Digest of a conversation's damaged rows (turn, role, text) by definition."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, _, _ in rows if t is not None]
    seen, full, kinds = set(), [], []
    for _, role, text in rows:
        body = WHITE.findall(text)
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        kinds.append(kind)
        full.append((role, text, kind in ("blank", "duplicate"), kind == "truncated"))
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, turns_out = cheapest(full)
    body = "\n".join(f"{r}:{t}" for r, t in turns_out)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256(body.encode()).hexdigest())


def hurt(rows):
    """The planted damage, row by row."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        own.extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    return {conv: plain(own) for conv, own in out.items()}


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


SCHEMA = "conv_id long, turn long, role string, text string"


def invented(seed, conversations, longest=7):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "u"]
    texts = ["Yes.", "Yes.", "No!  ", "cut off", "", " \t", None, "Wer da? ", "ende\x0b", "Ünd.", "a"]
    return [
        (conv, None if rng.random() < 0.06 else rng.randrange(6), rng.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0], rng.choice(texts))
        for conv in range(conversations) for _ in range(rng.randrange(longest))
    ]


def test_tables_against_search():
    rng = random.Random(3)
    t = fr.tables()
    for _ in range(400):
        signs = np.array([rng.randrange(9) for _ in range(rng.randrange(11))], np.int64)
        rows = [("suat"[s // 2] if s < 8 else "t", "x", s == 8, s < 8 and s % 2) for s in signs.tolist()]
        cost, audit, _ = cheapest(rows)
        front, behind, added = fr.cost_of(signs)
        letters, state = fr.traced(signs, behind)
        assert added + t.vectors[front][0] == cost and "".join(letters) + fr.ending(state) == audit
        ids, total, leaves = fr.summary(signs)
        assert (ids[0], total[0], leaves[0, 0]) == (front, added, state)


@pytest.mark.parametrize("chunk", [2, 4096])
def test_brute_force(spark, chunk):
    rows = invented(1, 90) + [(None, 1, "user", "Hi."), (None, 2, "user", "Hi."), (7, 3, "user", "word " * 100_000)]
    rows += [(500, t, r, f"{x}.") for t, (r, x) in enumerate(itertools.islice(itertools.cycle([("user", 1), ("assistant", 2), ("user", 3)]), 11))]
    rows += [(501, 1, "user", "Same.")] * 40
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    digest, turns = repair.repaired(repair.damaged(df), copies="copies", chunk=chunk)
    want = hurt(rows)
    assert found(digest) == want
    joined = {}
    for r in sorted(turns.collect(), key=lambda r: (r.part, r.chunk)):
        joined.setdefault(r.conv_id, []).extend(f"{t.role}:{t.text}" for t in r.turns)
    assert {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in joined.items()} == {c: x[-1] for c, x in want.items()}


def test_long_conversation_over_many_tasks(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "assistant", "user", "system", "x"]
    rows = [(1, t, rng.choice(roles), rng.choice(["Go.", "on", "", f"Row {t}.", f"row {t}"])) for t in range(3000)] + [(0, 0, "user", "A."), (2, 0, "user", "B.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = found(repair.repaired(df, chunk=200, with_turns=False)[0])
        whole = found(repair.repaired(df, chunk=10_000, with_turns=False)[0])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    signs = repair.Piece([(t, r, x, 1) for _, t, r, x in rows[:3000]])
    cost, audit, turns = signs.edits()
    assert pieces == whole and whole[1][5:7] == (cost, audit)
    assert GOOD.match("".join(r[0] for r, _ in turns))


def test_empty_and_clashing_names(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert found(repair.repaired(repair.damaged(none), copies="copies", with_turns=False)[0]) == {}
    rows = [(c, t, r, x, 7, "none") for c, t, r, x in invented(2, 8)]
    df = spark.createDataFrame(rows, SCHEMA + ", copies int, conv string")
    assert found(repair.repaired(repair.damaged(df), copies="copies", with_turns=False)[0]) == hurt([r[:4] for r in rows])
    one = spark.createDataFrame([(4, 4, "user", "a", 0)], SCHEMA + ", copies int")
    assert found(repair.repaired(one, copies="copies", with_turns=False)[0]) == {4: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_digest(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(repair.op12_block_repair(spark, sf)) == hurt(rows)
