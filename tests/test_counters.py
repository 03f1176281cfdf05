"""Deltas of cumulative counters: resets, edges, empty windows, ties."""
import datetime as dt

import pytest

from ledgerwatch.operators import series

T0 = dt.datetime(2024, 1, 1)


def deltas(spark, points, period=60):
    df = spark.createDataFrame([("m", {"s": s}, T0 + dt.timedelta(seconds=t), v) for s, t, v in points], "metric string, labels map<string,string>, ts timestamp_ntz, value double")
    return {(r["labels"]["s"], int((r["window_start"] - T0).total_seconds())): r["value"] for r in series.counter_delta(df, period).collect()}


def test_resets_within_and_across_windows(spark):
    got = deltas(spark, [("a", 0, 10.0), ("a", 30, 16.0), ("a", 50, 4.0), ("a", 70, 2.0), ("a", 80, 5.0)])
    assert got == {("a", 0): pytest.approx(6 + 4 + 1), ("a", 60): pytest.approx(1 + 3)}  # 50 to 70: reset, 2 spread over both


def test_rises_spread_over_empty_windows(spark):
    got = deltas(spark, [("a", 30, 0.0), ("a", 210, 18.0), ("b", 5, 7.0)])
    assert got == {("a", 0): pytest.approx(3), ("a", 60): pytest.approx(6), ("a", 120): pytest.approx(6), ("a", 180): pytest.approx(3), ("b", 0): 0.0}


def test_ties_nulls_and_order(spark):
    got = deltas(spark, [("a", 20, 5.0), ("a", 10, 1.0), ("a", 20, 3.0), ("a", 15, None), ("a", 30, 5.0)])
    assert got == {("a", 0): pytest.approx(4)}
    assert deltas(spark, []) == {}


def test_windows_between_far_points_are_not_shuffled(spark):
    points = [("a", 0, 0.0), ("a", 60 * 5000 + 30, 10001.0), ("b", 30, 1.0), ("b", 90, 4.0), ("b", 150, 2.0)]
    got = deltas(spark, points)
    assert len(got) == 5001 + 3 and sum(v for (s, _), v in got.items() if s == "a") == pytest.approx(10001.0)
    assert (got["b", 0], got["b", 60], got["b", 120]) == (pytest.approx(1.5), pytest.approx(2.5), pytest.approx(1.0))
    df = spark.createDataFrame([("m", {"s": s}, T0 + dt.timedelta(seconds=t), v) for s, t, v in points], "metric string, labels map<string,string>, ts timestamp_ntz, value double")
    plan = series.counter_delta(df, 60)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 2 and plan.rindex("Exchange ") > plan.index("Generate explode")


def test_points_without_a_time_keep_their_window(spark):
    df = spark.createDataFrame([("m", {"s": "a"}, None, 5.0), ("m", {"s": "a"}, T0, 1.0), ("m", {"s": "a"}, T0 + dt.timedelta(seconds=90), 4.0)],
                               "metric string, labels map<string,string>, ts timestamp_ntz, value double")
    got = {r["window_start"]: r["value"] for r in series.counter_delta(df, 60).collect()}
    assert got == {None: 0.0, T0: pytest.approx(2.0), T0 + dt.timedelta(seconds=60): pytest.approx(1.0)}
