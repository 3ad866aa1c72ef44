"""Repeated passages against brute force over all 50-byte strings."""

import hashlib
import random

import numpy as np

from headroom.llm import suffixes


def brute(rows):
    first = {}
    for i, text in rows:
        b = (text or "").encode()
        if i is not None:
            for k in range(len(b) - 49):
                w = b[k : k + 50]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, text in rows:
        b = (text or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - 49):
            if i is not None and first[b[k : k + 50]] < i:
                gone[k : k + 50] = [True] * 50
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    draw = random.Random(seed)
    letters = "abcdefghij é"
    line = lambda n: "".join(draw.choice(letters) for _ in range(n))
    passages = [line(draw.choice([49, 50, 51, 80, 300])) for _ in range(12)]
    rows = []
    for i in range(60):
        text = "".join(line(draw.randrange(90)) + draw.choice(passages)[draw.randrange(8) :] for _ in range(draw.randrange(5)))
        rows.append((draw.randrange(10**12) if i % 7 else i, text))
    rows += [(3, rows[5][1]), (4, rows[5][1]), (4, rows[6][1]), (None, rows[5][1]), (None, None), (9, None), (10, ""), (11, "z" * 5000), (12, "z" * 300), (13, "ab" * 400)]
    return rows


def test_brute_force(spark, table):
    for seed in (1, 2):
        rows = corpus(seed)
        docs = table(rows).selectExpr("*", "1 as part", "2 as block", "3 as doc").repartition(3)
        found = suffixes.repeated_passages(docs, parts=5)
        got = [(r.doc, r.size, r.size - len(r.text), len(r.starts), hashlib.sha256(r.text).hexdigest()) for r in found.collect()]
        assert sorted(got, key=repr) == brute(rows)


def test_query_on_driver_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in suffixes.op9_suffix_radix(spark, sf).collect()), key=repr) == brute(rows)


def test_empty_table(table):
    assert suffixes.repeated_passages(table([])).count() == 0


def test_passages_that_differ_inside(spark, table):
    """Changed bytes 50 to 75 apart: anchors meet in many documents, and only some of their suffixes are repeated."""
    draw = random.Random(5)
    passage = "".join(draw.choice("abcdefgh ") for _ in range(600))
    rows = []
    for i in range(80):
        text, at = list(passage), draw.randrange(70)
        while at < len(text):
            text[at] = draw.choice("XYZ")
            at += draw.randrange(50, 76)
        rows.append((draw.randrange(10**9), "".join(text[draw.randrange(100) : 400 + draw.randrange(200)])))
    found = suffixes.repeated_passages(table(rows).repartition(4), parts=3)
    got = sorted(((r.doc, r.size, r.size - len(r.text), len(r.starts), hashlib.sha256(r.text).hexdigest()) for r in found.collect()), key=repr)
    assert got == brute(rows) and any(0 < r[2] < r[1] for r in got)


def test_cells_cover_every_suffix_of_an_anchor():
    text = np.frombuffer("".join(random.Random(2).choice("abcd") for _ in range(5000)).encode(), np.uint8)
    a = suffixes.anchored(text, np.array([0, 1800, 1849, 5000]))
    cells = suffixes.celled(a, text, np.ones(len(a["at"]), bool))
    covered = np.concatenate([np.arange(low, high + 1) for low, high in zip(cells["low"], cells["high"])])
    whole = np.concatenate([np.arange(low, high + 1) for low, high in zip(a["low"], a["high"])])
    assert np.array_equal(np.sort(covered), np.sort(whole)) and (cells["high"] - cells["low"] < suffixes.CELL).all()
    strings = {}
    for digit, low, high in zip(cells["digit"], cells["low"], cells["high"]):
        for at in range(low, high + 1):
            strings.setdefault(text[at : at + 50].tobytes(), set()).add(digit)
    assert all(len(digits) == 1 for digits in strings.values())  # equal suffixes meet in one core


def test_anchors_spread_over_all_parts():
    """An anchor is the least of many hashes; its digit must not be, else the first part gets a quarter of them."""
    text = np.frombuffer("".join(random.Random(4).choices("abcdefgh ", k=300_000)).encode(), np.uint8)
    a = suffixes.anchored(text, np.array([0, len(text)]))
    rows = list(suffixes._dealt(1, suffixes._entries(a, np.array([7])), 64))
    sizes = [len(keys) // 8 for _, _, _, keys, _ in rows]
    assert len(rows) == 64 and max(sizes) < 2 * sum(sizes) / 64


def test_a_shared_passage_is_one_entry_a_block(spark, table):
    """Copies in one block send each key once; wide and negative ids keep their order."""
    draw = random.Random(6)
    passage = np.frombuffer("".join(draw.choice("abcdefgh ") for _ in range(2000)).encode(), np.uint8)
    one = suffixes.anchored(passage, np.array([0, 2000]))
    many = suffixes.anchored(np.tile(passage, 40), np.arange(41) * 2000)
    ids = np.array([draw.randrange(-(2**63), 2**63) for _ in range(40)])
    rows = list(suffixes._dealt(1, suffixes._entries(many, ids), 4))
    assert sum(len(keys) // 8 for _, _, _, keys, _ in rows) <= len(one["at"])
    assert {base for _, _, base, _, _ in rows} == {ids.min()}
    rows = [(int(i), passage.tobytes().decode()[: 1900 + k] + "x" * (k % 3)) for k, i in enumerate(ids)]
    found = suffixes.repeated_passages(table(rows).repartition(3), parts=3)
    got = [(r.doc, r.size, r.size - len(r.text), len(r.starts), hashlib.sha256(r.text).hexdigest()) for r in found.collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_number_of_parts():
    assert suffixes.number_of_parts(0, 4) == 8 and suffixes.number_of_parts(1685, 51) == 105
    assert suffixes.number_of_parts(98_000, 3000) == 1531  # four times as many blocks a part, not 6,125 parts of few entries
