"""Split and unsplit forms give the same rows; properties against brute force."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from plain_rows import rows
from pyspark.sql import functions as F

from headroom.operators import combine as cb
from headroom.operators import exceedance as x
from headroom.operators import quantiles as q
from headroom.operators import ranks as rk
from headroom.operators import series as s
from headroom.operators import sizing as z
from headroom.operators import triples as tr

T0 = datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def sample(spark):
    """One group with most of the rows, many equal values, a wide range of sizes."""
    rng = np.random.default_rng(11)
    values = np.concatenate([np.round(rng.normal(0, 50, 3000), 1), np.full(1500, 7.0), 10.0 ** rng.uniform(-3, 6, 400), [0.0, -0.0]])
    groups = np.where(rng.random(len(values)) < 0.7, "hot", np.where(rng.random(len(values)) < 0.5, "a", "b"))
    data = [(str(g), float(v)) for g, v in zip(groups, values)] + [("a", None), ("hot", float("nan"))]
    return spark.createDataFrame(data, "k string, v double"), {g: sorted(v for k, v in data if k == g and v is not None and v == v) for g in ("hot", "a", "b")}


@pytest.mark.parametrize("split", [False, True])
def test_values_at_ranks(spark, sample, split):
    df, truth = sample
    counts = rk.value_counts(df, "v", "k")
    asked = [(k, r, i) for i, (k, r) in enumerate((k, r) for k, v in truth.items() for r in (-1, 0, 1, len(v) // 3, len(v) - 1, len(v)))]
    got = {r.tag: r.value for r in rk.values_at_ranks(counts, spark.createDataFrame(asked, "k string, rank long, tag int"), "k", split).collect()}
    for k, r, tag in asked:
        assert got[tag] == (truth[k][r] if 0 <= r < len(truth[k]) else None)


@pytest.mark.parametrize("split", [False, True])
def test_counts_at_values(spark, sample, split):
    df, truth = sample
    counts = rk.value_counts(df, "v", "k")
    asked = [(k, t) for k in truth for t in (-1e9, -20.05, 0.0, 7.0, 7.01, 999.0, 1e9)]
    got = {(r.k, r.value): (r.n_below, r.n_upto) for r in rk.counts_at_values(counts, spark.createDataFrame(asked, "k string, value double"), "k", split).collect()}
    for k, t in asked:
        assert got[(k, t)] == (sum(v < t for v in truth[k]), sum(v <= t for v in truth[k]))


def test_crowded_values_spread_over_all_ranges(spark):
    """200,001 values between 49.9 and 50.1: every range gets its share, and the answers are exact."""
    df = spark.range(200_001).select(F.lit("k").alias("k"), (F.lit(49.9) + F.col("id") * 1e-6).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        known = rk.distribution_of(df, "v", "k")
        sizes = [r["count"] for r in known.rows.groupBy("__part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes) and known.directory.count() == 4
    found = rows(known.values_at(spark.createDataFrame([("k", r) for r in (0, 77_777, 200_000)], "k string, rank long")))
    assert [r[2] for r in found] == [49.9 + r[1] * 1e-6 for r in found] and len(found) == 3
    asked = spark.createDataFrame([("k", 49.9 + 12_345 * 1e-6), ("k", 50.2), ("k", 1.0)], "k string, value double")
    assert [r[2:] for r in rows(known.counts_at(asked))] == [(0, 0), (12_345, 12_346), (200_001, 200_001)]
    known.drop()


def test_grid_residual_and_bootstrap_split_forms_agree(spark, sample):
    df, truth = sample

    def close(a, b):
        assert len(a) == len(b) > 0
        for left, right in zip(a, b):
            assert left == pytest.approx(right, rel=1e-9) if not isinstance(left[0], str) else left[0] == right[0] and left[1:] == pytest.approx(right[1:], rel=1e-9)

    grid = [rows(z.symmetric_percentile_grid(df, 20.0, "v", "k", split=f).where("percent in (0.0, 0.1, 0.489)")) for f in (False, True)]
    close(*grid)
    for k, percent, lower, upper, off, within, span in grid[0]:
        v = truth[k]
        assert off == pytest.approx(100 * sum(y > upper + 20 or y < lower - 20 for y in v) / len(v))
        assert span == pytest.approx(100 * sum(lower - 1e-9 <= y <= upper + 1e-9 for y in v) / len(v)) and within == pytest.approx(100 - off)
    close(*[rows(z.bootstrap_percentiles(df, [0.1, 0.9], "v", "k", simulations=3, samples=200, split=f)) for f in (False, True)])
    direct = rows(z.bootstrap_percentiles(df, [0.5], "v", "k", simulations=3, samples=200))
    counted = rows(z.bootstrap_percentiles(z.distribution(df, "v", "k"), [0.5], "v", "k", simulations=3, samples=200, weight="weight"))
    close(direct, counted)


def test_bootstrap_equals_resampling_the_values(spark):
    df = spark.createDataFrame([(float(v * v),) for v in range(50)], "v double")
    counts = rk.value_counts(df, "v")
    draws = z.bootstrap_draws(rk.group_sizes(counts), 4, 300, 9).toPandas()
    expected = [np.percentile((draws[draws.sim == i]["rank"] ** 2).to_numpy(), 30) for i in range(4)]
    got = z.bootstrap_percentiles(df, [0.3], "v", simulations=4, samples=300, seed=9).first()
    assert got["mean"] == pytest.approx(np.mean(expected)) and got["std"] == pytest.approx(np.std(expected, ddof=1))


def _cascade(levels):
    """Plain restatement: {level: (proposed, [realised…])} -> {level: allowed}."""
    used, out = 0.0, {}
    for level in sorted(levels, reverse=True):
        proposed, parts = levels[level]
        out[level] = max(min(proposed - used, sum(parts)), 0.0)
        used += out[level]
    return out


def test_cascade_against_brute_force_with_non_monotone_proposals(spark):
    rng = random.Random(4)
    truth, data = {}, []
    for k in range(40):
        truth[k] = {level: (float(rng.randint(0, 60)), [float(rng.randint(0, 30)) for _ in range(rng.randint(1, 3))]) for level in rng.sample(range(90, 101), 5)}
        data += [(k, level, str(1), i, p, r) for level, (p, parts) in truth[k].items() for i, r in enumerate(parts)]
    df = spark.createDataFrame(data, "k int, level int, version_number string, sender int, proposed double, realised double")
    got = {(r.k, r.level, r.sender): r.value for r in x.exceeded_cascade(df, "k").collect()}
    expected = {}
    for k, levels in truth.items():
        over = [(p, r) for p, parts in levels.values() for r in parts if sum(parts) > p]
        if sum(r for _, r in over) <= sum(p for p, _ in over):
            continue
        for level, allowed in _cascade(levels).items():
            parts = levels[level][1]
            for i, r in enumerate(parts):
                share = (r / sum(parts) if sum(parts) else 0.0) * allowed
                if abs(share - r) > 0:
                    expected[(k, level, i)] = share
    assert got.keys() == expected.keys() and len(got) > 20
    assert all(got[key] == pytest.approx(expected[key]) for key in got)


def test_proportion_uses_the_newest_version_when_the_level_is_ambiguous(spark):
    data = [("a", 99, "1", 0, 10.0, 9.0), ("a", 99, "2", 0, 20.0, 9.0), ("a", 99, "2", 1, 20.0, 19.0), ("a", 98, "1", 0, 30.0, 1.0), ("b", 99, "1", 0, 10.0, 4.0)]
    df = spark.createDataFrame(data, "k string, level int, version_number string, sender int, proposed double, realised double")
    got = rows(x.exceeded_proportion(df, "k").select("k", "level", "version_number", "sender", F.round("value", 6)))
    total = 9 / 20 + 19 / 20
    assert got == [("a", 99, "2", 0, round(9 / 20 / total * 20, 6)), ("a", 99, "2", 1, round(19 / 20 / total * 20, 6))]


def test_resample_is_idempotent_and_split_forms_agree(spark):
    rng = random.Random(2)
    data = []
    for k in ("hot", "cold"):
        for m in sorted(rng.sample(range(0, 60 * 24 * 20), 300)):
            data.append((T0 + timedelta(minutes=m), T0 + timedelta(minutes=m + 7), k, rng.choice([None, float(m)])))
    df = spark.createDataFrame(data, "valid_from timestamp_ntz, valid_to timestamp_ntz, k string, v double")
    for shared in (False, True):
        once = s.resample_ffill(df, "PT15M", "v", "k", shared_range=shared, split=False)
        assert rows(once) == rows(s.resample_ffill(df, "PT15M", "v", "k", shared_range=shared, split=True))
    full = s.resample_ffill(df, "PT15M", "v", "k")
    assert rows(full) == rows(s.resample_ffill(full, "PT15M", "v", "k"))
    gaps = s.resample_mean(df, "PT15M", "v", "k")
    for method in ("ffill", "bfill"):
        assert rows(s.fill_missing(gaps, "v", "k", method=method, split=False)) == rows(s.fill_missing(gaps, "v", "k", method=method, split=True, chunk=3600))


def test_add_is_commutative(spark):
    tables = [
        spark.createDataFrame([(T0 + timedelta(minutes=15 * i), T0 + timedelta(minutes=15 * i + 15), k, float(i + j)) for i in range(j, 6) for k in ("a", "b")[: j + 1]],
                              "valid_from timestamp_ntz, valid_to timestamp_ntz, k string, value double") for j in (0, 1)
    ]
    assert rows(cb.combine_add(tables, "k")) == rows(cb.combine_add(tables[::-1], "k"))


def test_lower_quantile_at_zero_is_the_floored_minimum(spark, sample):
    df, truth = sample
    assert {r.k: r.value for r in q.quantile_lower(df, "v", [0], "k").collect()} == {k: max(v[0], 0.0) for k, v in truth.items()}


def test_triples_take_the_nearest_ancestor_and_stop_at_the_depth(spark):
    data = [("d", "Type", "Document", "root"), ("d", "name", "far", "root"), ("s", "Type", "Series", "d"), ("s", "name", "near", "d"),
            ("s", "unit", "MW", "d"), ("p1", "Type", "Point", "s"), ("p1", "q", "1", "s"), ("p2", "Type", "Point", "s"), ("p2", "name", "own", "s"),
            ("r", "Type", "Reason", "p1"), ("r", "text", "why", "p1")]
    df = spark.createDataFrame(data, "ID string, KEY string, VALUE string, PARENT_ID string")
    got = {r.ID: r.asDict() for r in tr.triples_to_table(df, "Point").collect()}
    assert got["p1"]["name"] == "near" and got["p2"]["name"] == "own" and got["p1"]["unit"] == "MW"
    assert got["p1"]["Series_ID"] == "s" and got["p1"]["Document_ID"] == "d" and got["p1"]["Reason_ID"] == "r" and got["p1"]["text"] == "why"
    assert got["p2"]["text"] is None and got["p1"]["Point_PARENT_ID"] == "s"
    shallow = tr.triples_to_table(df, "Point", parents=1, child=False)
    assert "Document_ID" not in shallow.columns and "text" not in shallow.columns
    assert [r[0] for r in tr.triples_roots(df).collect()] == ["root"]


@pytest.mark.parametrize("by", [[], ["k"]])
def test_next_in_order_over_chunks(spark, by):
    rng = random.Random(8)
    data = sorted({(rng.choice(["a", "b", None]) if by else "a", rng.randint(-500, 500)) for _ in range(300)}, key=repr)
    df = spark.createDataFrame(data, "k string, c long")
    got = {(r.k, r.c): r["__next"] for r in s.next_in_order(df, "c", 32, by).collect()}
    for k, c in data:
        later = [x for g, x in data if g == k and x > c]
        assert got[k, c] == (min(later) if later else None)
    plan = s.next_in_order(df, "c", 32, by)._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [plan[i + 1] for i, line in enumerate(plan) if "SinglePartition" in line]
    assert all("keys=[__chunk" in line for line in below)  # only the rows of a chunk each meet in one task
