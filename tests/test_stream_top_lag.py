"""Streaming top series within their bounds, and lag points of a feed that open an incident."""
import os
import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import series
from ledgerwatch.plans import policies
from ledgerwatch.sources import fixtures as fx
from ledgerwatch.sources.tables import SilverTable
from ledgerwatch.streaming import cdc, incidents, lag, top

SF = "/root/testdata/sf0.001"
PERIOD = 3600


def test_counters_keep_their_bounds():
    rng = random.Random(3)
    for capacity in (1, 4, 32):
        counters, true = top.Counters(capacity), {}
        for _ in range(5000):
            name, value = f"s{int(rng.paretovariate(0.7)) % 200}", float(rng.randrange(4))
            true[name] = true.get(name, 0) + value
            counters.add(name, value)
        weight = sum(true.values())
        assert counters.weight == weight and len(counters.held) <= capacity and counters.floor() <= weight / capacity
        for name, n in true.items():
            if name in counters.held:
                total, error = counters.held[name]
                assert total - error <= n <= total and error <= counters.floor()
            else:
                assert n <= counters.floor()
    with pytest.raises(ValueError, match="negative"):
        counters.add("s", -1.0)


@pytest.fixture()
def rocks(spark):
    old = {k: spark.conf.get(k, None) for k in incidents.STATE_STORE}
    for k, v in incidents.STATE_STORE.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stream_top_against_the_batch_query(spark, tmp_dir, rocks):
    """Two runs of one query over three files; all windows but those behind the watermark are in."""
    pts = fx.metric_points(spark, SF).filter(F.col("value") >= 0).withColumn("labels", F.create_map(F.lit("k"), F.pmod(F.hash("ts", "value"), F.lit(40)).cast("string")))
    path, out, ck = (os.path.join(tmp_dir, n) for n in ("points", "out", "ck"))
    first, last = pts.agg(F.min("ts"), F.max("ts")).first()
    edges = [first + (last - first) * k / 3 for k in (1, 2)]
    part = F.when(F.col("ts") < F.lit(edges[0]), 0).when(F.col("ts") < F.lit(edges[1]), 1).otherwise(2)
    pts = pts.withColumn("part", part).cache()

    def run(*parts):
        for k in parts:
            pts.filter(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(pts.drop("part").schema).option("maxFilesPerTrigger", 1).parquet(path)
        rows = top.stream_top(stream, PERIOD, capacity=6, buckets=4, watermark="1 second")
        q = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(300)
        assert q.exception() is None

    run(0, 1), run(2)
    reports = spark.read.parquet(out)
    now = [r.asDict() for r in top.newest(reports).collect()]
    seen = max(r["as_of"] for r in now)
    aligned = series.align(pts, PERIOD, "ALIGN_SUM").filter(F.col("window_end") <= F.lit(seen).cast("timestamp_ntz"))
    bucket = F.pmod(F.xxhash64("metric", "series"), F.lit(4)).cast("int")
    true = aligned.groupBy("metric", F.to_json(F.map_from_entries("series_key")).alias("series")).agg(F.sum("value").alias("total")).withColumn("bucket", bucket).collect()
    held = {(r["metric"], r["series"]): r for r in now}
    of = {(r["metric"], r["bucket"]): r for r in now}
    assert len(true) > len(held)  # some had to go
    for r in true:
        there = of[r["metric"], r["bucket"]]
        mine = held.get((r["metric"], r["series"]))
        assert there["floor"] <= there["weight"] / 6 * (1 + 1e-9)
        if mine is None:
            assert r["total"] <= there["floor"] * (1 + 1e-9)
        else:
            assert mine["total"] - mine["error"] <= r["total"] * (1 + 1e-9) + 1e-9 and r["total"] <= mine["total"] * (1 + 1e-9)
    weight = {}
    for r in true:
        weight[r["metric"], r["bucket"]] = weight.get((r["metric"], r["bucket"]), 0) + r["total"]
    assert all(abs(of[k]["weight"] - w) <= 1e-6 * w for k, w in weight.items())
    best = sorted(true, key=lambda r: (-r["total"], r["metric"], r["series"]))[:5]
    got = top.top(reports, 5).collect()
    assert len(got) == 5
    assert {(r["metric"], r["series"]) for r in got if r["certain"]} <= {(r["metric"], r["series"]) for r in best}


def _wait(found, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        try:
            if found():
                return
        except Exception:  # the table is not there yet
            pass
        time.sleep(0.5)
    raise AssertionError("no points")


@pytest.mark.parametrize("delay_s, opens", [(7200, True), (60, False)])
def test_a_delayed_feed_opens_the_lag_incident(spark, tmp_dir, delay_s, opens):
    feed, points = os.path.join(tmp_dir, "feed"), os.path.join(tmp_dir, "points")
    for _ in range(8):
        spark.range(3).select("id", (F.current_timestamp() - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(delay_s))).alias("updated_at")).coalesce(1).write.mode("append").parquet(feed)
    ticks = iter(range(100))
    listener = lag.LagListener(spark, "lag-test", points, "orders", clock=lambda _: datetime(2024, 1, 1) + timedelta(seconds=60 * next(ticks)))
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("id long, updated_at timestamp").option("maxFilesPerTrigger", 1).parquet(feed)
        q = lag.observed(stream, "lag-test").writeStream.format("noop").option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None
        _wait(lambda: spark.read.parquet(points).count() == 8)
    finally:
        spark.streams.removeListener(listener)
    pts = spark.read.parquet(points)
    low, high = pts.agg(F.min("value"), F.max("value")).first()
    assert delay_s <= low <= high <= delay_s + 300
    chosen = [p for p in policies.monitoring_policies("e", ["orders"]) if p.policy_id == "stream_lag"]
    assert len(chosen) == 1
    notes = policies.evaluate_policies(pts, chosen, "2024-01-01 01:00:00")["notifications"].collect()
    assert [(r["policy_id"], "orders" in r["message"]) for r in notes] == ([("stream_lag", True)] if opens else [])


def test_the_upsert_reports_its_lag(spark, tmp_dir):
    raw = fx.raw_orders(spark, SF, lineage=False).limit(50)
    root, points = os.path.join(tmp_dir, "cdc"), os.path.join(tmp_dir, "points")
    raw.coalesce(1).write.parquet(os.path.join(root, "public_orders"))
    newest, oldest = raw.agg(F.max("updated_at"), F.min("updated_at")).first()
    q = cdc.start_silver_upsert(cdc.cdc_stream(spark, root), SilverTable(spark, os.path.join(tmp_dir, "silver")), os.path.join(tmp_dir, "ck"),
                                available_now=True, ingest_ts="2002-01-01 00:00:00", lag_points_path=points)
    q.awaitTermination(300)
    assert q.exception() is None
    _wait(lambda: spark.read.parquet(points).count() == 1)
    point = spark.read.parquet(points).first()
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert point["labels"] == {"stream_id": "public_orders"} and 0 <= (now - oldest).total_seconds() - point["value"] < 600
