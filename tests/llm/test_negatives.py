import math

import numpy as np
import pytest

from headroom.llm import negatives as hn

SCHEMA = "vec_id long, label int, embedding array<double>"


def plain(rows, every=50):
    """Brute force over (id, label, vector)."""
    full = []
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        full.append((i, label, [math.floor(256 * x) for x in vector]))
    out = []
    for i, label, vector in full:
        if i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(vector, v)), j, lab) for j, lab, v in full if j != i))
        for minus, p, _ in [x for x in scored if x[2] == label][:5]:
            window = [x for x in scored if x[2] != label and -50 * minus <= -100 * x[0] <= -95 * minus]
            out += [(i, p, k + 1, n, -minus, -s) for k, (s, n, _) in enumerate(window[:3])]
    return sorted(out)


def invented(seed, n, dims=6, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    rows = []
    for i in range(n):
        label = int(rng.integers(4))
        rows.append((i, label, [float(x) for x in centres[rng.integers(4)] + spread * rng.normal(size=dims)]))
    return rows


@pytest.mark.parametrize("block,round_size", [(8192, 16_384), (64, 5)])
def test_brute_force(spark, block, round_size):
    rows = invented(1, 500)
    rows += [(1000, 1, [1.0, None] * 3), (1001, 1, [float("nan")] * 6), (1002, 1, [float("inf")] * 6), (1003, None, [1.0] * 6), (1004, 1, None), (None, 1, [1.0] * 6)]
    rows += [(1005, 2, [0.5, 0.5]), (1050, 2, [0.5, 0.25, -0.25]), (1100, 3, []), (1150, 0, [0.0] * 6), (1200, 1, [1e9] * 6), (-50, 1, [0.25] * 6)]
    rows += [(2000 + i, i % 3, [0.5, -0.5, 0.25, 0.0, 0.0, 0.0]) for i in range(40)]  # ties
    found = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(2), block=block, round_size=round_size)
    want = plain([r for r in rows if r[0] != 1200])  # its components are too large to take part
    assert sorted(tuple(r) for r in found.collect()) == want and len(want) > 100


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 2, [float(x) for x in rng.normal(size=5) * 300_000 / 2]) for i in range(120)]
    rows = [r for r in rows if max(map(abs, r[2])) < 500_000]
    assert sorted(tuple(r) for r in hn.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()) == plain(rows)


def test_access_stops_early():
    rng = np.random.default_rng(2)
    matrix = np.round(256 * rng.normal(size=(4000, 2))).astype(np.int64)
    block = hn.Block(hn._pack(np.arange(4000), np.zeros(4000, np.int64), matrix).to_pylist()[0])
    for anchor in (np.array([200, 1]), np.array([-3, 90]), np.array([50, -50]), np.array([0, 7])):
        kept = [(hn.NONE, hn.NONE)]

        def keep(chosen, scores):
            kept[0] = hn.best(np.concatenate((kept[0][0], scores)), np.concatenate((kept[0][1], chosen)), 5)

        seen = block.descend(anchor, np.ones(4000, bool), keep, lambda bar: len(kept[0][0]) == 5 and bar < kept[0][0][-1])
        full = matrix @ anchor
        assert kept[0][1].tolist() == np.lexsort((np.arange(4000), -full))[:5].tolist() and seen < 1500


def test_empty_and_clashing_names(spark):
    assert hn.hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = invented(3, 120)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", score int, id string")
    assert sorted(tuple(r) for r in hn.hard_negatives(df).collect()) == plain(rows)


def test_repeated_rows_take_part(spark):
    rows = invented(5, 150)
    rows += rows[:3] + rows[60:70]
    want = plain(rows)
    assert sorted(tuple(r) for r in hn.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()) == want
