"""Hand-made cases for the semantics the results depend on."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from plain_rows import rows
from pyspark.sql import functions as F

from headroom.functions import ceil_dec, duration_seconds, floor_dec, format_iso_duration, parse_datetime_any, parse_iso_duration, safe_ratio
from headroom.operators import areas as a
from headroom.operators import capacity as cap
from headroom.operators import columns as c
from headroom.operators import combine as cb
from headroom.operators import exceedance as x
from headroom.operators import filters as f
from headroom.operators import merge as m
from headroom.operators import quantiles as q
from headroom.operators import series as s
from headroom.operators import sizing as z
from headroom.sources import points as p

T0 = datetime(2024, 3, 1)
Q = timedelta(minutes=15)


def cells(spark, data, by="area string"):
    """(quarter, product, value) -> table with times."""
    rows_ = [(T0 + i * Q, T0 + (i + 1) * Q, k, v) for i, k, v in data]
    return spark.createDataFrame(rows_, f"valid_from timestamp_ntz, valid_to timestamp_ntz, {by}, value double")


def test_lower_quantile_is_the_order_statistic_below(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "v double")
    got = {r.tick: r.value for r in q.quantile_lower(df, "v", [0, 500, 9500, 10000]).collect()}
    assert got == {0: 0.0, 500: 0.0, 9500: 8.0, 10000: 9.0}


@pytest.mark.parametrize("split", [False, True])
def test_quantiles_match_pandas(spark, split):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"k": rng.integers(0, 3, 700), "v": np.round(rng.normal(0, 40, 700), 1)})
    df = spark.createDataFrame(frame)
    ticks = list(range(0, 10001, 250))
    low = {(r.k, r.tick): r.value for r in q.quantile_lower(df, "v", ticks, "k", floor_zero=False, split=split).collect()}
    linear = {(r.k, round(r.probability * 10000)): r.value for r in q.quantile_linear(df, "v", [t / 10000 for t in ticks], "k", split=split).collect()}
    for k, part in frame.groupby("k"):
        for t in ticks:
            n = len(part)
            assert low[(k, t)] == sorted(part.v)[t * (n - 1) // 10000]
            assert linear[(k, t)] == pytest.approx(part.v.quantile(t / 10000))


def test_quantiles_drop_nulls_and_floor_at_zero(spark):
    df = spark.createDataFrame([("a", -5.0), ("a", None), ("a", float("nan")), ("a", 7.0), ("b", None)], "k string, v double")
    assert rows(q.quantile_lower(df, "v", [0, 10000], "k").select("k", "percentage_level", "value")) == [("a", 0.0, 7.0), ("a", 100.0, 0.0)]


def test_spacing_labels_run_backwards(spark):
    got = q.quantile_spacing(spark, [(95, 100, 0.1)]).orderBy("tick").collect()
    assert len(got) == 51 and got[0].percentage_level == 100.0 and got[-1].percentage_level == 95.0 and got[-1].probability == 0.05


def test_double_weight_counts_rows_twice_with_closed_bounds(spark):
    df = cells(spark, [(0, "a", 1.0), (4, "a", 2.0), (8, "a", 3.0)])
    end = T0 + 8 * Q
    assert rows(s.double_weight(df, end, "PT1H").groupBy("value").count()) == [(1.0, 1), (2.0, 2), (3.0, 2)]
    assert rows(s.double_weight(df, end, "PT1H", weight="w").select("value", "w")) == [(1.0, 1), (2.0, 2), (3.0, 2)]


@pytest.mark.parametrize("split", [False, True])
def test_resample_is_an_as_of_lookup_on_a_midnight_grid(spark, split):
    at = lambda minutes: T0 + timedelta(minutes=minutes)
    df = spark.createDataFrame(
        [(at(20), at(50), "a", 1.0), (at(50), at(80), "a", 2.0), (at(5), at(10), "b", 9.0)], "valid_from timestamp_ntz, valid_to timestamp_ntz, k string, v double"
    )
    got = rows(s.resample_ffill(df, "PT15M", "v", "k", split=split).where("k = 'a'").select("valid_from", "v"))
    # the cell before the first observation is null; the last interval reaches its own end
    assert got == [(at(15), None), (at(30), 1.0), (at(45), 1.0), (at(60), 2.0)]
    wide = s.resample_ffill(df, "PT15M", "v", "k", shared_range=True, split=split)
    assert wide.where("k = 'b'").count() == wide.where("k = 'a'").count() == 5


def test_resample_downwards_takes_the_last_value_and_keeps_the_last_duplicate(spark):
    df = cells(spark, [(0, "a", 1.0), (3, "a", 2.0), (4, "a", 3.0), (4, "a", 4.0), (6, "a", 5.0)])
    got = rows(s.resample_ffill(df, "PT1H", "value", "area", tie="value").select("valid_from", "value"))
    assert got == [(T0, 1.0), (T0 + 4 * Q, 4.0)]


def test_resample_mean_leaves_empty_cells_null(spark):
    df = cells(spark, [(0, "a", 1.0), (1, "a", 3.0), (9, "a", 5.0)])
    assert [r[1] for r in rows(s.resample_mean(df, 3600, "value", "area").select("valid_from", "value"))] == [2.0, None, 5.0]


def test_add_skips_nulls_subtract_spreads_them_min_skips(spark):
    left = cells(spark, [(0, "a", 5.0), (0, "b", None), (1, "a", 4.0), (2, "a", 1.0), (0, "only", 7.0)])
    right = cells(spark, [(0, "a", 2.0), (0, "b", 3.0), (1, "b", 6.0)])

    def got(function):
        return {(r.valid_from, r.area): r.value for r in function([left, right], "area").collect()}

    t1 = T0 + Q
    assert got(cb.combine_add) == {(T0, "a"): 7.0, (T0, "b"): 3.0, (T0, "only"): 7.0, (t1, "a"): 4.0, (t1, "b"): 6.0}
    # both tables know a and b, so their gaps are nulls; a product of one table passes through
    assert got(cb.combine_subtract) == {(T0, "a"): 3.0, (T0, "b"): None, (T0, "only"): 7.0, (t1, "a"): None, (t1, "b"): None}
    assert got(cb.combine_min)[(T0, "b")] == 3.0 and got(cb.combine_max)[(T0, "a")] == 5.0


def test_pivot_sum_of_nulls_is_zero_and_mean_drops(spark):
    df = cells(spark, [(0, "a", None), (0, "b", 2.0), (0, None, 1.0)])
    assert rows(cb.pivot_products(df, "value", "area").select("area", "value")) == [("a", 0.0), ("b", 2.0)]
    assert rows(cb.pivot_products(df, "value", "area", how="mean").select("area", "value")) == [("b", 2.0)]


def test_latest_version_groups_nulls_and_keeps_ties(spark):
    df = spark.createDataFrame([(None, "9", 1), (None, "10", 2), (None, "10", 3), ("x", "2", 4)], "k string, version_number string, timestamp int")
    assert rows(f.latest_version(df)) == [("x", "2", 4), (None, "10", 2), (None, "10", 3)]


def test_group_extreme_over_value_only_merges_equal_values(spark):
    df = spark.createDataFrame([("a", 5.0, 1), ("a", 5.0, 2), ("a", 6.0, 1)], "k string, v double, position int")
    assert rows(f.filter_group_extreme(df, {"position": "max"}, ["k", "v"])) == [("a", 5.0, 2), ("a", 6.0, 1)]


def test_exclusive_groups_keep_one_bid_and_all_ungrouped(spark):
    df = spark.createDataFrame([(1, "g", 5.0), (2, "g", 9.0), (3, "g", 9.0), (4, None, 1.0), (5, None, 1.0)], "id int, g string, v double")
    assert [r[0] for r in rows(f.pick_group_argmax(df, "g", "v", tie="id"))] == [2, 4, 5]


def test_time_of_day_slice_is_closed_wraps_midnight_and_follows_summer_time(spark):
    times = [datetime(2024, 1, 10, 22, 59, 59), datetime(2024, 1, 10, 23, 0), datetime(2024, 1, 11, 4, 59, 59), datetime(2024, 7, 10, 22, 0), datetime(2024, 7, 11, 3, 59, 59), datetime(2024, 7, 11, 4, 0)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, valid_from timestamp_ntz")
    night = spark.createDataFrame([(1, "00:00:00", "05:59:59", "CET")], "position int, start_time string, end_time string, time_zone string")
    assert [r[0] for r in rows(f.slice_time_of_day(df, night))] == [1, 2, 3, 4]
    wrap = spark.createDataFrame([(1, "23:30:00", "00:30:00", "UTC")], "position int, start_time string, end_time string, time_zone string")
    late = spark.createDataFrame([(1, datetime(2024, 1, 1, 23, 30)), (2, datetime(2024, 1, 1, 0, 30)), (3, datetime(2024, 1, 1, 1, 0))], "i int, valid_from timestamp_ntz")
    assert [r[0] for r in rows(f.slice_time_of_day(late, wrap))] == [1, 2]


def test_slices_split_the_day(spark):
    got = s.time_slices(spark, datetime(2024, 2, 1, 23), datetime(2024, 2, 2, 23), 6).collect()
    assert [r.start_time for r in got][:2] == ["00:00:00", "04:00:00"] and got[-1].end_time == "23:59:59" and got[0].point_resolution == "PT4H"
    assert s.time_slices(spark, T0, T0, 1).collect()[0].start_time is None
    fine = s.time_slices(spark, T0, T0 + timedelta(minutes=20), 4).collect()
    assert fine[1].valid_from - fine[0].valid_from == Q  # never below a quarter of an hour


def test_safe_ratio_and_rounding(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 0.0), (0.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"))).collect()] == [0.5, 2.0, 0.0]
    one = spark.range(1).select(ceil_dec(F.lit(10.5612), 2), floor_dec(F.lit(10.5678), 2), ceil_dec(F.lit(-1.25), 1)).first()
    assert tuple(one) == (10.57, 10.56, -1.2)


def test_next_version_starts_at_one_then_two(spark):
    new = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    stored = spark.createDataFrame([("b", "0"), ("c", "3"), ("c", "12")], "k string, version_number string")
    assert rows(x.next_version(new, "k", stored)) == [("a", 1), ("b", 2), ("c", 13)]


def test_scan_bounds(spark):
    df = cells(spark, [(i, "a", 1.0) for i in range(4)])
    assert p.scan_time_range(df, T0, T0 + 2 * Q).count() == 2
    assert p.scan_time_range(df, T0, T0 + 2 * Q, ["valid_from", "valid_to"]).count() == 2
    assert p.scan_time_range(df, T0, T0 + 3 * Q).count() == 3


def test_filters_reach_the_scan(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    found = p.filter_by_spec(p.scan_time_range(events, datetime(2024, 1, 5), None, "ts"), {"event_type": ["click", "view"], "range": {"value": {"gte": 5}}})
    plan = found.select("event_id")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(ts" in pushed and "In(event_type" in pushed and "IsNotNull(value)" in pushed
    assert "props" not in plan


def test_must_not_keeps_rows_without_the_field(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    assert [r[0] for r in rows(p.filter_by_spec(df, {"must_not": [{"k": "a"}]}))] == [2, 3]
    assert [r[0] for r in rows(p.filter_by_spec(df, {"bool": {"should": [{"k": "a"}, {"id": "3"}]}}, {"match_all": {}}))] == [1, 3]


def test_durations(spark):
    texts = ["PT15M", "-P3D", "P1Y", "PT0S", "P2M1DT1H", "PT1,5H", "P", "PT", "abc", None, "P1W"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_iso_duration(F.col("t"))).collect()]
    assert got == [900, -259200, 31536000, 0, 5184000 + 86400 + 3600, 5400, None, None, None, None, 604800]
    back = spark.createDataFrame([(900,), (0,), (90061,), (-86400,), (172800,)], "s long").select(format_iso_duration(F.col("s"))).collect()
    assert [r[0] for r in back] == ["PT15M", None, "P1DT1H1M1S", "-P1D", "P2D"]
    assert duration_seconds("-P3D") == -259200
    with pytest.raises(ValueError):
        duration_seconds("soon")


def test_parse_datetime_any(spark):
    df = spark.createDataFrame([("2024-01-02T03:04Z",), ("2024-01-02T03:04:05+0200",), ("2 Jan 2024 03:04 C",), ("2024-01-02",), ("hello",), ("12",)], "t string")
    got = [r[0] for r in df.select(parse_datetime_any(F.col("t")).cast("timestamp_ntz")).collect()]
    assert got == [datetime(2024, 1, 2, 3, 4), datetime(2024, 1, 2, 1, 4, 5), datetime(2024, 1, 2, 6, 4), datetime(2024, 1, 2), None, None]


def test_contains_without_hit_does_not_filter_or_duplicate(spark):
    df = spark.createDataFrame([(1, "SA_mFRR"), (2, "aFRR"), (3, None)], "id int, k string")
    assert f.filter_contains(df, {"k": ["nothing"]}).count() == 3
    assert [r[0] for r in rows(f.filter_contains(df, {"k": ["frr", "mfrr"]}))] == [1, 2]


def test_negative_policy_cut_needs_every_product(spark):
    df = cells(spark, [(0, "a", 1.0), (0, "b", 2.0), (1, "a", 1.0), (2, "a", -1.0), (2, "b", 1.0), (3, "a", 1.0), (3, "b", None)])
    assert f.negative_policy(df, "cut", product="area").count() == 2
    assert rows(f.negative_policy(df, "zero").where("valid_from = timestamp_ntz'2024-03-01 00:30:00'").select("value")) == [(0.0,), (1.0,)]
    assert f.negative_policy(df, "none").count() == 7


def test_limit_bids_ignores_missing_capacity(spark):
    bids = spark.createDataFrame([("Estonia", "UP", 99.0, 50.0), ("Latvia", "UP", 99.0, 50.0), ("Estonia", "UP", 98.0, 50.0)], "area string, direction string, percentage_level double, value double")
    capacity = spark.createDataFrame([("EE", "LV", 99.0, 30.0), ("LV", "LT", 99.0, 20.0), ("LV", "EE", 99.0, 60.0)], "out_area string, in_area string, percentage_level double, value double")
    got = {(r.area, r.percentage_level): r.value for r in cap.limit_bids_by_capacity(bids, capacity, a.correction_keys(spark)).collect()}
    assert got == {("Estonia", 99.0): 20.0, ("Latvia", 99.0): 20.0, ("Estonia", 98.0): 50.0}


def test_net_capacity_fills_each_side_first(spark):
    def table(data):
        return spark.createDataFrame([(T0 + i * Q, T0 + (i + 1) * Q, o, n, v) for i, o, n, v in data], "valid_from timestamp_ntz, valid_to timestamp_ntz, out_area string, in_area string, value double")

    ahead = table([(0, "A", "B", 100.0), (0, "B", "A", 80.0), (1, "B", "A", 70.0)])
    intra = table([(0, "A", "B", 10.0), (0, "B", "A", 5.0), (1, "A", "B", 20.0)])
    expected = {(T0, "A"): 95.0, (T0, "B"): 85.0, (T0 + Q, "A"): 85.0, (T0 + Q, "B"): 85.0}
    for step in (None, 900):
        got = {(r.valid_from, r.out_area): r.value for r in cap.net_border_capacity([ahead, intra], step=step).collect()}
        assert got == expected


def test_align_labels_matches_id_name_code_and_operator(spark):
    labels = spark.createDataFrame([("10y1001A1001A39I",), ("area of ESTONIA north",), ("lv",), ("Litgrid AB",), ("XX",), (None,), ("",)], "label string")
    got = [r[0] for r in a.align_labels(labels, "label", a.default_areas(spark), "code").collect()]
    assert sorted(map(str, got)) == sorted(["EE", "EE", "LV", "LT", "XX", "None", ""])


def test_roles_renames_and_empty_columns(spark):
    df = spark.createDataFrame([(1, 2, None)], "`domain.MRID` int, `Value.value` int, empty string")
    assert c.resolve_roles(df, {"area": ["x", "domain.mRID"], "value": "value.value", "gone": "none"}).columns == ["area", "value"]
    assert c.drop_columns(df).columns == ["domain.MRID", "Value.value"]
    both = spark.createDataFrame([(1, 2)], "a int, b int")
    assert c.rename_by_mapping(both, {"a": "b"}).columns == ["b", "b_2"]
    assert c.rename_by_mapping(both, {"a": "b"}, overwrite=False).columns == ["b"]


def test_percentile_labels(spark):
    assert z.percentile_labels([-99.5, 99.5]) == {0.005: "99.5% for -", 0.995: "99.5% for +"}
    with pytest.raises(ValueError):
        z.percentile_labels([-99.5, 0.5])


def test_merge_operators(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, name string, v double")
    new = spark.createDataFrame([(2, None, 5.0), (3, "c", None)], "k int, name string, v double")
    assert rows(m.update_by_key(old, new, "k")) == [(1, "a", 1.0), (2, "b", 5.0), (3, "c", None)]
    assert rows(m.update_by_key(old, new, "k", insert=False)) == [(1, "a", 1.0), (2, "b", 5.0)]
    assert [r[0] for r in rows(m.append_missing(old, new, "k"))] == [1, 2, 3]


def test_fill_steps_clamps_keeps_duplicates_and_fills_fields(spark):
    day = timedelta(days=1)
    data = [(T0, T0 + 5 * day, "x", "P1D", T0 + i * day, T0 + (i + 1) * day, v, n) for i, v, n in ((0, 1.0, 1), (1, 2.0, 2), (1, 3.0, 3), (3, None, 4))]
    df = spark.createDataFrame(data, "series_from timestamp_ntz, series_to timestamp_ntz, k string, resolution string, valid_from timestamp_ntz, valid_to timestamp_ntz, v double, n int")
    got = rows(s.fill_steps(df, "k", tie="n").select("valid_from", "v", "n"))
    assert got == [(T0, 1.0, 1), (T0 + day, 2.0, 2), (T0 + day, 3.0, 3), (T0 + 2 * day, 3.0, 3), (T0 + 3 * day, 3.0, 4), (T0 + 4 * day, 3.0, 4)]
    cut = rows(s.fill_steps(df, "k", tie="n", start=T0 + day, end=T0 + 3 * day).select("valid_from", "v"))
    assert cut == [(T0 + day, 2.0), (T0 + day, 3.0), (T0 + 2 * day, 3.0)]
    # no row of the series lies in the window: its grid is empty, not missing
    empty = rows(s.fill_steps(df, "k", tie="n", start=T0 + 4 * day, end=T0 + 5 * day).select("k", "valid_from", "v"))
    assert empty == [("x", T0 + 4 * day, None)]


def test_resample_mean_runs_to_the_end_of_the_last_interval(spark):
    hour = timedelta(hours=1)
    df = spark.createDataFrame([(T0, T0 + hour, 1.0), (T0 + hour, T0 + 2 * hour, 2.0)], "valid_from timestamp_ntz, valid_to timestamp_ntz, v double")
    fine = rows(s.resample_mean(df, "PT15M", "v").select("valid_from", "v"))
    assert len(fine) == 8 and fine[0][1] == 1.0 and fine[4][1] == 2.0 and fine[7] == (T0 + 7 * hour / 4, None)
    assert rows(s.resample_named(df, "sum", "PT2H", "v").select("v")) == [(3.0,)]
    assert s.resample_named(df, "unknown", "PT2H", "v") is df


def test_period_bounds_couple_to_the_validity_period(spark):
    df = spark.createDataFrame([(T0, "-P3D", "-P2D", "P4D", None, "P60D"), (T0, "-P3D", "-P2D", None, None, None)], "now timestamp_ntz, valid_offset string, valid_delta string, shift string, data_offset string, data_delta string")
    day = timedelta(days=1)
    got = [(r.valid_from, r.valid_to, r.data_from, r.data_to) for r in s.period_bounds(df).collect()]
    assert got[0] == (T0 + 3 * day, T0 + 5 * day, T0 + day - 60 * day, T0 + day)
    assert got[1] == (T0 + 3 * day, T0 + 5 * day, T0 - 60 * day, T0)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_groups_are_limited_or_combined_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 k", "id * 1.0D v")
    for picked in (f.dedupe_last(df, "k", "v"), f.pick_group_argmax(df, "k", "v", tie="id"), m.distinct_rows(df, "k", "id")):
        plan = _plan(picked)
        assert "WindowGroupLimit" in plan and plan.rindex("Partial") > plan.rindex("Exchange hashpartitioning")
    assert "partial_max" in _plan(f.filter_group_extreme(df, {"v": "max"}, "k"))


def test_combine_shuffles_once(spark):
    df = cells(spark, [(0, "a", 1.0)])
    plan = _plan(cb.combine_add([df, df, df], "area"))
    assert plan.count("Exchange hashpartitioning") == 1


def test_forecast_reads_the_points_once(spark, sf):
    from headroom.catalog import plan_queries, views

    seen = []
    bids = views.bids(spark, sf)
    marked = bids.where(F.col("id") >= 0)
    tree = {"SUBTRACT": [{"ADD": [{"product": "SA_mFRR"}, {"product": "DA_mFRR"}]}, {"product": "aFRR"}]}

    def prepare(rows_, keys):
        seen.append(rows_._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
        return rows_

    cb.combine_tree(marked, tree, ["area"], "quantity", prepare=prepare)
    assert seen == [1] and "bid_forecast" in plan_queries.QUERIES
