"""SILVER table upserts (touched partitions) and the streaming variants."""
import os

from pyspark.sql import functions as F

from ledgerwatch.operators import alerts, series, upsert
from ledgerwatch.sources import fixtures as fx
from ledgerwatch.sources.tables import SilverTable, branch_counts_row
from ledgerwatch.streaming import absence as SA
from ledgerwatch.streaming import alerts as STA
from ledgerwatch.streaming import cdc
from ledgerwatch.streaming import series as SS

SF = "/root/testdata/sf0.001"
LINEAGE = ["l_partkey", "l_suppkey", "l_linenumber"]
COLS = ["order_id", "customer_id", "product", "quantity", "unit_price", "total_price", "status", "region",
        "created_at", "updated_at", "_source", "order_date"]


def test_silver_table_upsert_matches_in_memory_merge(spark, tmp_dir):
    seed, inc = fx.split_raw(fx.raw_orders(spark, SF))
    t = SilverTable(spark, os.path.join(tmp_dir, "silver"))
    c1 = branch_counts_row(t.upsert(seed, "2002-01-01 00:00:00", extra_order=fx.TIE_BREAK).counts).first()
    assert c1["inserted"] > 0 and c1["updated"] == 0
    r2 = t.upsert(inc, "2002-01-01 00:15:00", extra_order=fx.TIE_BREAK)
    c2 = branch_counts_row(r2.counts).first()
    assert c2["inserted"] > 0 and c2["updated"] > 0 and c2["unchanged"] > 0
    expected = fx.silver_merged(spark, SF)
    got = t.read()
    assert sorted(got.select(COLS).collect()) == sorted(expected.select(COLS).collect())
    # replaying the incoming batch changes nothing
    c3 = branch_counts_row(t.upsert(inc, "2002-01-01 00:30:00", extra_order=fx.TIE_BREAK).counts).first()
    assert c3["inserted"] == 0 and c3["updated"] == 0
    assert sorted(t.read().collect()) == sorted(got.collect())


def test_stream_cdc_equals_batch(spark, tmp_dir):
    seed, inc = fx.split_raw(fx.raw_orders(spark, SF))
    root = os.path.join(tmp_dir, "cdc")
    seed.drop(*LINEAGE).write.parquet(os.path.join(root, "public_orders"))
    inc.drop(*LINEAGE).write.mode("append").parquet(os.path.join(root, "public_orders"))
    t = SilverTable(spark, os.path.join(tmp_dir, "silver"))
    q = cdc.start_silver_upsert(cdc.cdc_stream(spark, root), t, os.path.join(tmp_dir, "ck"), available_now=True,
                                ingest_ts="2002-01-01 00:00:00")
    q.awaitTermination(600)
    assert q.exception() is None
    # one micro-batch holds both halves: same as merging the latest row of all versions
    latest = upsert.prepare_source(fx.raw_orders(spark, SF, lineage=False))[0]
    assert t.read().count() == latest.count()
    assert t.read().select("order_id").distinct().count() == t.read().count()


def test_stream_align_and_absence_equal_batch(spark, tmp_dir):
    pts = fx.metric_points(spark, SF)
    path = os.path.join(tmp_dir, "points")
    pts.write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    q = (SS.stream_align(stream, 300, "ALIGN_SUM", watermark="0 seconds").drop("series_key", "labels")
         .writeStream.format("memory").queryName("aligned_t").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select metric, window_start, value from aligned_t")
    batch = series.align(pts, 300, "ALIGN_SUM").select("metric", "window_start", "value")
    max_start = batch.agg(F.max("window_start")).first()[0]
    # append mode holds back only the windows the watermark has not passed yet
    missing = batch.exceptAll(got.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))
    assert missing.filter(F.col("window_start") < max_start).count() == 0

    q = (SA.stream_absence(stream, 300, 3600, watermark="0 seconds")
         .writeStream.format("memory").queryName("absent_t").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    rows = [(r["metric"], r["series"], r["gap_start"], r["fired_at"]) for r in spark.sql("select * from absent_t").collect()]
    ep = alerts.absence_episodes(series.align(pts, 300, "ALIGN_SUM"), 3600, "2100-01-01 00:00:00")
    latest = pts.agg(F.max("ts")).first()[0]  # the watermark: later gaps are not reported yet
    want = ep.filter(F.col("fired_at") < F.lit(latest)).select(
        "metric", F.to_json(F.map_from_entries("series_key")).alias("series"), "episode_start", "fired_at").collect()
    assert len(rows) == len(set(rows)) and rows
    assert set(rows) == {tuple(r) for r in want}


def test_incremental_revenue_mart_equals_full_rebuild(spark, tmp_dir):
    from ledgerwatch.operators import marts
    from ledgerwatch.sources.tables import refresh_revenue_mart
    seed, inc = fx.split_raw(fx.raw_orders(spark, SF))
    t = SilverTable(spark, os.path.join(tmp_dir, "silver"))
    mart = os.path.join(tmp_dir, "revenue")
    r1 = t.upsert(seed, "2002-01-01 00:00:00", extra_order=fx.TIE_BREAK)
    refresh_revenue_mart(t, r1.changed_dates, mart)
    r2 = t.upsert(inc, "2002-01-01 00:15:00", extra_order=fx.TIE_BREAK)
    refresh_revenue_mart(t, r2.changed_dates, mart)
    # a batch that cancels every order of one date empties that mart partition
    day = t.read().select("order_date").orderBy("order_date").first()[0]
    cancel = (t.read().filter(F.col("order_date") == day)
              .withColumn("status", F.lit("cancelled"))
              .withColumn("updated_at", F.timestamp_add("DAY", F.lit(1), F.col("updated_at"))))
    r3 = t.upsert(cancel.drop("_ingested_at", "_source", "order_date"), "2002-01-01 00:30:00")
    refresh_revenue_mart(t, r3.changed_dates, mart)
    got = spark.read.parquet(mart)
    full = marts.revenue_by_product(t.read())
    cols = sorted(full.columns)
    assert sorted(got.select(cols).collect()) == sorted(full.select(cols).collect())
    assert got.filter(F.col("order_date") == day).count() == 0


def test_absence_waits_for_late_windows_and_forgets_silent_series():
    period, duration = 300, 900
    assert SA.decide([300], 1199, period, duration) == ([], [300])          # windows before 1200 may still come
    assert SA.decide([300], 1200, period, duration) == ([300], [])          # reported, and out of the state
    assert SA.decide([300, 900], 1200, period, duration) == ([], [900])     # a window in time ends the question
    assert SA.decide([300, 1500], 1200, period, duration) == ([300], [1500])  # a window too late
    assert SA.decide([1500, 300, 600, 300], 0, period, duration) == ([], [1500])
    assert SA.decide([300], 1000, period, 700) == ([], [300])               # 700 s settle on the grid at 1200


def test_stream_episodes_and_incidents_equal_batch(spark, tmp_dir):
    pts = fx.metric_points(spark, SF).withColumn("labels", F.create_map().cast("map<string,string>"))
    path = os.path.join(tmp_dir, "points")
    pts.write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    latest = pts.agg(F.max("ts")).first()[0]

    def run(df, name):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").start()
        q.processAllAvailable()
        q.stop()
        return spark.sql(f"select * from {name}")

    flagged = alerts.threshold_flags(series.align(pts, 300, "ALIGN_SUM"), "COMPARISON_GT", 20.0)
    for duration, name in ((0, "hold_0"), (300, "hold_300")):
        got = run(STA.stream_hold_episodes(stream, 300, duration, "COMPARISON_GT", 20.0, watermark="0 seconds"), name)
        cols = ["metric", "episode_start", "fired_at", "episode_end", "windows", F.round("peak_value", 6).alias("p")]
        closed = alerts.hold_episodes(flagged, 300, duration).filter(F.timestamp_add("SECOND", F.lit(600), "episode_end") < F.lit(latest))
        want, rows = {tuple(r) for r in closed.select(*cols).collect()}, [tuple(r) for r in got.select(*cols).collect()]
        assert want and want <= set(rows) and len(rows) == len(set(rows))
        assert set(rows) <= {tuple(r) for r in alerts.hold_episodes(flagged, 300, duration).select(*cols).collect()}

    got = run(STA.stream_incidents(stream, 300, 3600, "COMPARISON_GT", 20.0, watermark="0 seconds"), "incidents_t")
    batch = alerts.incidents(alerts.hold_episodes(flagged, 300, 0), 3600).select("metric", "opened_at", "resolved_at")
    closed = batch.filter(F.timestamp_add("SECOND", F.lit(4200), "resolved_at") < F.lit(latest))
    want, rows = {tuple(r) for r in closed.collect()}, [tuple(r) for r in got.select("metric", "opened_at", "resolved_at").collect()]
    assert want and want <= set(rows) <= {tuple(r) for r in batch.collect()} and len(rows) == len(set(rows))
