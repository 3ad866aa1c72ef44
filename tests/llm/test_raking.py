"""Raking against a plain Python fit, and the calibration of the sample."""

from collections import Counter

from headroom.llm import raking as r


def fit(cells, powers, sweeps):
    now, total = dict.fromkeys(cells, 0.0) | cells, sum(cells.values())
    for _ in range(sweeps):
        for axis, power in enumerate(powers):
            sums, first = Counter(), Counter()
            for c, v in now.items():
                sums[c[axis]] += v
                first[c[axis]] += cells[c]
            mass = sum(v**power for v in first.values())
            now = {c: v * (first[c[axis]] ** power / mass * total / sums[c[axis]]) for c, v in now.items()}
    return now


def test_fit_and_calibration(spark, table):
    rows = []
    for i in range(3000):
        source, lang = f"s{min(i % 7, 3)}", ("en", "de", None)[(i * i) % 3]
        rows.append((i, "word " * (1 + i % 40) + (" a@b" if i % 5 == 0 else ""), lang, source if i % 11 else None))
    rows += [(9001, ""), (9002, None), (None, "a b c"), (None, "a b c")]
    out = r.mixed(table(rows).selectExpr("*", "1 as tokens", "2 as raked", "3 as target")).collect()
    assert len(out) == len(rows)
    cells = Counter()
    for x in out:
        assert x["__tokens"] == len((x.text or "").split())
        cells[x["__source"], x["__lang"], x["__topic"]] += x["__tokens"]
    cells = {c: v for c, v in cells.items() if v}
    want = fit(cells, r.POWERS.values(), r.SWEEPS)
    kept = Counter()
    for x in out:
        c = x["__source"], x["__lang"], x["__topic"]
        if x["__tokens"]:
            ratio = want[c] / cells[c] * r.RATE
            assert abs(x["__probability"] - min(1, ratio)) < 1e-9 and abs(x["__weight"] * x["__probability"] - ratio) < 1e-9
        else:
            assert x["__kept"] and x["__weight"] == 1
        kept[c] += x["__kept"] * x["__weight"] * x["__tokens"]
    big = [c for c in want if want[c] > 5000]
    assert big and all(abs(kept[c] / (r.RATE * want[c]) - 1) < 0.25 for c in big)


def test_targets_are_met(spark):
    rows = [("a", "x", "p", 900), ("a", "y", "q", 50), ("b", "x", "q", 30), ("b", "y", "p", 20), ("b", "x", "p", 10), ("a", "y", "p", 40)]
    cells = spark.createDataFrame(rows, "__source string, __lang string, __topic string, tokens long")
    out = r.raked(cells, {"__source": 0.0, "__lang": 0.5, "__topic": 1.0}, 30).collect()
    by = Counter()
    for x in out:
        by[x["__source"]] += x.raked
    assert abs(by["a"] - 525) < 1 and abs(by["b"] - 525) < 1


def test_empty_table(table):
    assert r.mixed(table([])).count() == 0
