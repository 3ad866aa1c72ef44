"""Circulant MinHash against brute force over all pairs."""

import random
import re

from headroom.llm import minhash

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = SPACES.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {(i, len(sets[i]), find(i), find(i) == i) for i in sets}


def corpus():
    draw = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(12):
        base = [draw.choice(words) for _ in range(draw.choice([3, 6, 60, 200]))]
        for copy in range(6):
            text = list(base)
            for _ in range(copy if len(base) > 20 else 0):
                text[draw.randrange(len(text))] = draw.choice(words)
            rows.append(" ".join(text).upper() if copy % 2 else "  ".join(text) + "\n")
    rows += ["", None, " \t\n", "one", "one", "x " * 5000]
    return list(enumerate(rows, 10))


def test_brute_force(table):
    rows = corpus()
    got = minhash.near_duplicates(table(rows))
    assert {tuple(r) for r in got.collect()} == brute(rows, 85)


def test_nulls_empty_and_extra_columns(spark, table):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "a b c d e f")]
    got = sorted((tuple(r) for r in minhash.near_duplicates(table(rows)).collect()), key=repr)
    assert got == sorted([(None, 2, None, True)] * 2 + [(4, 2, 4, True)] * 2 + [(9, 2, 4, False)], key=repr)
    assert minhash.near_duplicates(table([])).count() == 0
    clash = table(rows).selectExpr("*", "1 as doc", "2 as bucket", "3 as component")
    assert minhash.deduplicated(clash).columns == clash.columns
    assert minhash.deduplicated(clash).count() == 4


def test_signature_estimates_similarity():
    import numpy as np

    draw = np.random.default_rng(1)
    a = draw.integers(0, 1 << 63, 400, dtype=np.uint64)
    b = np.concatenate((a[:300], draw.integers(0, 1 << 63, 100, dtype=np.uint64)))
    one, two = minhash.signatures(np.concatenate((a, b)), np.array([0, 400, 800]), 1000)
    assert abs((one == two).mean() - 300 / 500) < 0.08
