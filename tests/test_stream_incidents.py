"""Streaming incidents (holds and absences) equal the batch operators, however points are cut and ordered."""
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import alerts, series
from ledgerwatch.sources import fixtures as fx
from ledgerwatch.streaming import incidents as SI

SF = "/root/testdata/sf0.001"
PERIOD = 300
US = 1_000_000


def _rows(batch):
    return {tuple(r) for r in batch.collect()}


@pytest.mark.parametrize("kind, duration, auto_close", [("hold", 0, 0), ("hold", 600, 900), ("hold", 700, 1800), ("absence", 900, 0), ("absence", 1000, 2400), ("absence", 0, 600)])
def test_state_equals_batch_incidents(spark, kind, duration, auto_close):
    """Random series in random batches: every decision equals the batch operator's on the whole series."""
    rng = random.Random(f"{kind}{duration}{auto_close}")
    condition = SI.Condition(kind, PERIOD * US, duration * US, auto_close * US)
    got, windows, end = set(), [], 60 * PERIOD * US
    for k in range(60):
        starts = [i * PERIOD * US for i in range(40) if rng.random() < (0.7, 0.3, 0.9)[k % 3]]
        windows += [(f"s{k}", s // US) for s in starts]
        state, now, left = SI.Series(), 0, list(starts)
        while now < end:  # the watermark moves on; windows that end by it are in
            now += rng.choice([1, 2, 7, 30]) * PERIOD * US
            due = [s for s in left if s + PERIOD * US <= now]
            left = left[len(due):]
            for s in due:
                for row in (*condition.settle(state, s), *condition.advance(state, s)):
                    got.add((f"s{k}", *row))
            for row in condition.settle(state, now):
                got.add((f"s{k}", *row))
        assert kind == "absence" or state == SI.Series()  # a series without an open question leaves the state
    frame = spark.createDataFrame(windows, "series string, s long").select(
        "series", F.expr("timestamp_ntz '1970-01-01' + make_dt_interval(0, 0, 0, s)").alias("window_start"),
        F.expr(f"timestamp_ntz '1970-01-01' + make_dt_interval(0, 0, 0, s + {PERIOD})").alias("window_end"), F.lit(1.0).alias("value"), F.lit(True).alias("violating"))
    episodes = alerts.hold_episodes(frame, PERIOD, duration, ["series"]) if kind == "hold" else \
        alerts.absence_episodes(frame, duration, "1970-01-01 05:00:00", keys=["series"])
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    found = alerts.incidents(episodes, auto_close, keys=["series"]).select(
        "series", us("opened_at"), us("last_fired_at"), us("resolved_at"), "episodes").collect()
    want_open = {(r[0], "open", r[1], r[1], r[1], 1) for r in found}
    want_close = {(r[0], "close", r[3], r[1], r[2], r[4]) for r in found if r[3] is not None}
    assert {g for g in got if g[1] == "open"} == want_open and want_open
    assert {g for g in got if g[1] == "close"} == want_close
    assert len([g for g in got if g[1] == "renew"]) == sum(r[4] - 1 for r in found)


@pytest.fixture()
def rocks(spark):
    old = {k: spark.conf.get(k, None) for k in SI.STATE_STORE}
    for k, v in SI.STATE_STORE.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("kind", ["hold", "absence"])
def test_stream_incidents_over_shuffled_input_and_a_restart(spark, tmp_dir, rocks, kind):
    """Files whose points overlap in time (late within the watermark), and a query that stops and goes on."""
    pts = fx.metric_points(spark, SF).withColumn("labels", F.create_map().cast("map<string,string>"))
    path, out, ck = (os.path.join(tmp_dir, n) for n in ("points", "out", "ck"))
    first, last = pts.agg(F.min("ts"), F.max("ts")).first()
    third = (last - first) / 3
    late = F.pmod(F.hash("ts", "value", "metric"), F.lit(4)) == 0  # a fourth comes up to an hour late, in the file behind
    part = F.lit(0)
    for k in (1, 2):
        edge = F.lit(first + third * k)
        part = part + F.when(F.col("ts") >= edge, 1).when(late & (F.col("ts") >= edge - F.expr("interval 1 hour")), 1).otherwise(0)
    pts = pts.withColumn("part", part).cache()

    def add(k):
        pts.filter(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(path)

    def run():
        stream = spark.readStream.schema(pts.drop("part").schema).option("maxFilesPerTrigger", 1).parquet(path)
        rows = SI.stream_hold_incidents(stream, PERIOD, 300, 3600, "COMPARISON_GT", 20.0, watermark="1 hour") if kind == "hold" else \
            SI.stream_absence_incidents(stream, PERIOD, 1800, 3600, watermark="1 hour")
        q = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(300)
        assert q.exception() is None

    add(0), add(1), run(), add(2), run()
    got = [tuple(r) for r in spark.read.parquet(out).select("metric", "event", "at", "opened_at", "last_fired_at", "episodes").collect()]
    assert len(got) == len(set(got))
    aligned = series.align(pts, PERIOD, "ALIGN_SUM")
    episodes = alerts.hold_episodes(alerts.threshold_flags(aligned, "COMPARISON_GT", 20.0), PERIOD, 300) if kind == "hold" else \
        alerts.absence_episodes(aligned, 1800, "2100-01-01 00:00:00")
    found = alerts.incidents(episodes, 3600).collect()
    opened = {(r["metric"], "open", r["opened_at"], r["opened_at"], r["opened_at"], 1) for r in found}
    closed = {(r["metric"], "close", r["resolved_at"], r["opened_at"], r["last_fired_at"], r["episodes"]) for r in found if r["resolved_at"]}
    from datetime import timedelta
    mark = last - timedelta(hours=1)  # what the watermark has passed is reported, and nothing else
    early = lambda rows, wait: {r for r in rows if r[2] + timedelta(seconds=wait) <= mark}
    events = lambda name: {g for g in got if g[1] == name}
    assert early(opened, 2 * PERIOD) <= events("open") <= opened and events("open")
    assert early(closed, 3600 + 2 * PERIOD) <= events("close") <= closed and events("close")
