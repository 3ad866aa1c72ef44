"""SpotSigs: neighbours, edits and the similarity join against brute force."""

import hashlib
import random

from headroom.llm import spotsigs as s


def corpus():
    draw = random.Random(8)
    names = [f"n{i}" for i in range(200)]
    bases = [" ".join(draw.choice(["the", "of", "der"] if draw.random() < 0.4 else names) for _ in range(draw.choice([3, 40, 200]))) for _ in range(10)]
    rows = []
    for i in range(90):
        words = draw.choice(bases).split()
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = draw.choice(names)
        rows.append((draw.randrange(10**9), " ".join(words) + "é" * (i % 3)))
    return rows + [(5, ""), (6, None), (7, "!!"), (8, "ü"), (3, rows[0][1]), (3, rows[1][1]), (None, "x the y"), (None, "a the b")]


def ordered(rows):
    return sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))


def test_neighbours_and_edits(spark, table):
    import pyarrow as pa

    rows = corpus()
    spark.conf.set("spark.sql.shuffle.partitions", 7)
    got = s.compared_with_next(table(rows).selectExpr("*", "1 as bucket", "2 as guest", "3 as id")).collect()
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    rows, want = ordered(rows), []
    sets = s.signatures(pa.array([t for _, t in rows]))
    for k, (i, text) in enumerate(rows):
        behind = (k + 1) % len(rows)
        half = len(text) // 2
        edited = text[: len(text) - half] + rows[behind][1][:half]
        other = s.signatures(pa.array([edited]))[0]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), s.printed(sets[k]), s.printed(other), s.likeness(sets[k], other), s.likeness(sets[k], sets[behind])))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    by = {}
    for r, (_, text) in zip(want, rows):
        assert by.setdefault(text, r[3]) == r[3]
    assert len(set(by.values())) > 0.8 * len({t.strip("é") for t in by})


def test_one_row_follows_itself(table):
    r = s.compared_with_next(table([(1, "the cat sat on the mat")])).collect()
    assert len(r) == 1 and r[0].near_next == 1.0 and r[0].near_edited < 1.0
    assert s.compared_with_next(table([])).count() == 0


def test_similarity_join(table):
    rows = [(i, t) for i, (_, t) in enumerate(corpus())]
    prints = s.fingerprints(table(rows))
    got = {(r.low, r.high, round(r.likeness, 9)) for r in s.similar_pairs(prints, 0.6).collect()}
    first = {}
    for r in prints.orderBy("doc_id").collect():
        first.setdefault(r.fingerprint, r.doc_id)
    sets = {i: frozenset(f[k : k + 8] for k in range(0, len(f), 8)) for f, i in first.items() if f}
    want = set()
    for a in sets:
        for b in sets:
            alike = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            if a < b and alike >= 0.6:
                want.add((a, b, round(alike, 9)))
    assert got == want and want
