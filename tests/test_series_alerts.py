"""Alignment, reduction and alert conditions on hand-made series."""
import datetime as dt

from ledgerwatch.operators import alerts, series

T0 = dt.datetime(2024, 1, 1, 0, 0)


def pts(spark, rows):
    """rows: (metric, labels, minute offset, value)"""
    data = [(m, lab, T0 + dt.timedelta(minutes=mi), float(v)) for m, lab, mi, v in rows]
    return spark.createDataFrame(data, "metric string, labels map<string,string>, ts timestamp_ntz, value double")


def test_align_half_open_windows_and_aligners(spark):
    p = pts(spark, [("m", {"a": "1"}, 0, 1), ("m", {"a": "1"}, 4.99, 3), ("m", {"a": "1"}, 5, 10)])
    got = {(r["window_start"].minute, ): r["value"] for r in series.align(p, 300, "ALIGN_SUM").collect()}
    assert got == {(0,): 4.0, (5,): 10.0}
    rate = {r["window_start"].minute: r["value"] for r in series.align(p, 300, "ALIGN_RATE").collect()}
    assert rate[0] == 4.0 / 300
    frac = pts(spark, [("h", {}, 0, 1), ("h", {}, 1, 0), ("h", {}, 2, 1), ("h", {}, 3, 1)])
    assert series.align(frac, 300, "ALIGN_FRACTION_TRUE").first()["value"] == 0.75
    same = series.align(p, 300, "ALIGN_MAX", streaming_window=False).collect()
    assert sorted(r["value"] for r in same) == [3.0, 10.0]


def test_reduce_by_label_and_all(spark):
    p = pts(spark, [("m", {"a": "1", "b": "x"}, 0, 1), ("m", {"a": "1", "b": "y"}, 0, 2),
                    ("m", {"a": "2", "b": "x"}, 0, 4)])
    al = series.align(p, 300, "ALIGN_SUM")
    by_a = {r["labels"]["a"]: r["value"] for r in series.reduce(al, "REDUCE_SUM", ["a"]).collect()}
    assert by_a == {"1": 3.0, "2": 4.0}
    assert series.reduce(al, "REDUCE_MAX").first()["value"] == 4.0


def flagged(spark, minutes_values, comparison="COMPARISON_GT", threshold=0.0):
    p = pts(spark, [("m", {}, mi, v) for mi, v in minutes_values])
    return alerts.threshold_flags(series.align(p, 300, "ALIGN_SUM"), comparison, threshold)


def test_hold_just_under_and_over_duration(spark):
    # one violating window: spans 0 s -> fires with duration 0 only
    one = flagged(spark, [(0, 1)])
    assert alerts.hold_episodes(one, 300, 0).count() == 1
    assert alerts.hold_episodes(one, 300, 300).count() == 0
    # two consecutive windows: lasts 300 s -> fires at the second window
    two = flagged(spark, [(0, 1), (5, 1)])
    ep = alerts.hold_episodes(two, 300, 300).collect()
    assert len(ep) == 1 and ep[0]["fired_at"] == T0 + dt.timedelta(minutes=5)
    assert alerts.hold_episodes(two, 300, 301).count() == 0
    # a gap window breaks the run
    gap = flagged(spark, [(0, 1), (10, 1)])
    assert alerts.hold_episodes(gap, 300, 300).count() == 0
    # non-violating value between breaks the run too (LT condition)
    lt = flagged(spark, [(0, 0), (5, 1), (10, 0)], "COMPARISON_LT", 1)
    assert alerts.hold_episodes(lt, 300, 300).count() == 0


def test_absence_with_gap_and_silent_series(spark):
    p = pts(spark, [("m", {}, 0, 1), ("m", {}, 14, 1), ("m", {}, 40, 1)])
    al = series.align(p, 300, "ALIGN_SUM")
    as_of = T0 + dt.timedelta(minutes=60)
    ep = alerts.absence_episodes(al, 900, as_of).orderBy("fired_at").collect()
    # gap 5->10 min (5 min) no; gap 15->40 (25 min) yes; open gap 45->as_of (15 min) fires exactly at as_of
    assert [(r["episode_start"].minute, r["fired_at"].minute) for r in ep] == [(15, 30), (45, 0)]
    assert ep[1]["episode_end"] is None
    exp = spark.createDataFrame([("m", []), ("silent", [])],
                                "metric string, series_key array<struct<key:string,value:string>>")
    ep2 = alerts.absence_episodes(al, 900, as_of, expected=exp, since=T0)
    silent = [r for r in ep2.collect() if r["metric"] == "silent"]
    assert len(silent) == 1 and silent[0]["fired_at"] == T0 + dt.timedelta(minutes=15)


def test_incidents_auto_close_boundary(spark):
    rows = [("m", [], T0, T0 + dt.timedelta(minutes=5)),
            ("m", [], T0 + dt.timedelta(minutes=34, seconds=59), T0 + dt.timedelta(minutes=40)),  # < 1800 s gap
            ("m", [], T0 + dt.timedelta(minutes=70), T0 + dt.timedelta(minutes=75)),  # exactly 1800 s -> new
            ("m", [], T0 + dt.timedelta(minutes=120), None)]
    ep = spark.createDataFrame(
        [(m, k, f, f, e) for m, k, f, e in rows],
        "metric string, series_key array<struct<key:string,value:string>>, episode_start timestamp_ntz, "
        "fired_at timestamp_ntz, episode_end timestamp_ntz")
    inc = alerts.incidents(ep, 1800).orderBy("incident_seq").collect()
    assert [r["episodes"] for r in inc] == [2, 1, 1]
    assert inc[0]["resolved_at"] == T0 + dt.timedelta(minutes=40)
    assert inc[2]["resolved_at"] is None


def test_scorecard_colours(spark):
    p = pts(spark, [("h", {}, 0, 1), ("h", {}, 5, 0), ("u", {}, 0, 60)])
    al = series.align(p, 300, "ALIGN_MEAN")
    below = {r["metric"]: r["colour"] for r in series.scorecard(al, "BELOW", red=0.9).collect()}
    above = {r["metric"]: r["colour"] for r in series.scorecard(al, "ABOVE", yellow=50).collect()}
    assert below["h"] == "red" and above["u"] == "yellow"
