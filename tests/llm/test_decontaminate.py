"""Spaced-seed decontamination against a brute-force alignment over all diagonals."""

import random
import re

import pytest

from headroom.llm import decontaminate as d

BENCH = "item_id long, text string"


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def corpus():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(draw.choice([5, 8, 12, 30, 60])))) for i in range(30)]
    items += [(90, "the cat sat"), (91, None), (92, "")]
    docs, planted = [], set()
    for i in range(200):
        text = [word() for _ in range(draw.randrange(300))]
        if i % 4 == 0:
            item, passage = items[draw.randrange(30)]
            passage = passage.split()
            if len(passage) >= 30:
                for at in range(draw.randrange(9), len(passage), 9):  # every ninth word changed
                    passage[at] = word()
            at = draw.randrange(len(text) + 1)
            text[at:at] = [w.upper() + "," for w in passage]
            planted.add((i, item))
        docs.append((i, " ".join(text)))
    return docs + [(900, None), (901, ""), (902, "the cat sat on the mat")], items, planted


def test_planted_passages_and_nothing_else(spark, table):
    docs, items, planted = corpus()
    bench = spark.createDataFrame(items, BENCH)
    found = d.overlaps(table(docs), bench).collect()
    assert {(r.doc, r.item) for r in found} == planted
    by = dict(docs), dict(items)
    for r in found:
        a = tokens(by[0][r.doc])[r.doc_start : r.doc_start + r.tokens]
        b = tokens(by[1][r.item])[r.item_start : r.item_start + r.tokens]
        assert len(a) == len(b) == r.tokens and sum(x == y for x, y in zip(a, b)) == r.matched
    left = d.decontaminated(table(docs).selectExpr("*", "1 as doc", "2 as item", "3 as region"), bench)
    assert {r.doc_id for r in left.collect()} == {i for i, _ in docs} - {i for i, _ in planted}


def test_stretch_ends_at_the_best_score():
    import numpy as np

    same = np.array([0, 0, 0, 1, 1, 0, 1, 1, 1, 1, 0, 0, 0, 0, 0, 1], bool)
    assert d.stretch(same, 6) == (6, 10)
    assert d.stretch(np.ones(20, bool), 3) == (0, 20)


@pytest.mark.parametrize("docs, items", [([], [(1, "a b c d e f")]), ([(1, "a b c d e f")], []), ([(None, None)], [(None, None)])])
def test_empty_tables(spark, table, docs, items):
    assert d.overlaps(table(docs), spark.createDataFrame(items, BENCH)).count() == 0


def test_null_ids_and_repeated_rows(spark, table):
    text = "one two three four five six"
    docs = table([(None, text), (7, text), (7, text)])
    bench = spark.createDataFrame([(1, text), (1, text)], BENCH)
    assert sorted(((r.doc, r.tokens) for r in d.overlaps(docs, bench).collect()), key=repr) == [(7, 6), (None, 6)]
    assert [r.doc_id for r in d.decontaminated(docs, bench).collect()] == [None]


def test_every_stretch_of_a_diagonal_is_verified(spark, table):
    item = [f"w{i}" for i in range(60)]
    broken = [w if i % 22 < 15 else f"x{i}" for i, w in enumerate(item)]  # stretches at 0, 22 and 44
    weak = [w if 24 <= i < 36 else f"y{i}" for i, w in enumerate(item)]
    for first in (0, 50):  # seven of ten tokens under a mask: hits that fail by themselves
        for k, used in enumerate(d.MASKS[0]):
            if used == "1":
                weak[first + k] = item[first + k]
    found = d.overlaps(table([(1, " ".join(broken)), (2, " ".join(weak))]), spark.createDataFrame([(5, " ".join(item))], BENCH)).collect()
    assert sorted(r.doc_start for r in found if r.doc == 1) == [0, 22, 44]
    assert any(r.doc == 2 and r.doc_start == 24 and r.matched == 12 for r in found)
