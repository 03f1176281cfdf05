"""The SILVER upsert: whole-key matching, partition pruning, rejects, feed routing; and checks of specs."""
import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import audit, series
from ledgerwatch.plans import policies as PL
from ledgerwatch.sources import fixtures as fx
from ledgerwatch.sources.contracts import RAW_ORDERS
from ledgerwatch.sources.tables import SilverTable
from ledgerwatch.streaming import cdc

DAY = dt.datetime(2024, 1, 1)


def raw(spark, *rows):
    """(order_id, day of created_at, minutes of updated_at, status)"""
    full = [(o, 1, "p", 1, 1, 1, s, "r", DAY + dt.timedelta(days=d), DAY + dt.timedelta(days=9, minutes=m)) for o, d, m, s in rows]
    names = [f.name for f in RAW_ORDERS.fields]
    df = spark.createDataFrame(full, "order_id long, customer_id long, product string, quantity long, unit_price int, total_price int, "
                                     "status string, region string, created_at timestamp_ntz, updated_at timestamp_ntz")
    return df.select([F.col(f.name).cast(f.dataType) for f in RAW_ORDERS.fields]).select(*names)


def state(table):
    return sorted((r["order_id"], r["status"], r["order_date"].day) for r in table.read().collect())


def test_drifting_created_at_updates_the_stored_row(spark, tmp_dir):
    t = SilverTable(spark, os.path.join(tmp_dir, "silver"))
    t.upsert(raw(spark, (1, 0, 0, "pending"), (2, 0, 0, "pending"), (3, 5, 0, "pending")), "2024-02-01 00:00:00")
    r = t.upsert(raw(spark, (1, 3, 5, "shipped"), (4, 3, 0, "new"), (3, 1, -5, "late")), "2024-02-02 00:00:00")
    assert state(t) == [(1, "shipped", 1), (2, "pending", 1), (3, "pending", 6), (4, "new", 4)]
    assert {x["_action"]: x["rows"] for x in r.counts.collect()} == {"updated": 1, "inserted": 1, "unchanged": 1, "untouched": 1}
    assert sorted(x[0].day for x in r.changed_dates.collect()) == [1, 4]


def test_merge_opens_only_files_with_keys_of_the_batch_and_staging_is_removed(spark, tmp_dir):
    t = SilverTable(spark, os.path.join(tmp_dir, "silver"), rows_per_file=2)
    t.upsert(raw(spark, *((k, k, 0, "a") for k in range(9))), "2024-02-01 00:00:00")
    batch = raw(spark, (1, 4, 5, "b"))
    before = set(t.files())
    assert len(before) >= 4
    r = t.upsert(batch, "2024-02-02 00:00:00")
    assert len(r.gone) == 1 and before - set(t.files()) == set(r.gone)  # the other files are those of the version before
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:") + "/ledgerwatch"
    assert not [x for x in os.listdir(base) if x.startswith(("silver-batch", "silver-stage"))]


def test_rejects_are_kept_by_batch_and_replay_writes_them_once(spark, tmp_dir):
    t = SilverTable(spark, os.path.join(tmp_dir, "silver"))
    bad = raw(spark, (1, 0, 0, "ok"), (None, 0, 0, "x"), (3, 0, 0, None))
    for _ in range(2):
        r = t.upsert(bad, "2024-02-01 00:00:00", batch_id="b1")
    assert r.rejects_path.endswith("silver_rejects/batch_id=b1")
    got = spark.read.parquet(os.path.join(tmp_dir, "silver_rejects"))
    assert sorted((x["batch_id"], x["_reject_reason"]) for x in got.collect()) == [("b1", "null:order_id"), ("b1", "null:status")]
    assert state(t) == [(1, "ok", 1)]


def test_feed_merges_each_table_into_its_own_target_and_keeps_rejects(spark, tmp_dir):
    root = os.path.join(tmp_dir, "cdc")
    raw(spark, (1, 0, 0, "order"), (None, 0, 0, "bad")).write.parquet(os.path.join(root, "public_orders"))
    raw(spark, (1, 0, 9, "return")).write.parquet(os.path.join(root, "public_returns"))
    targets = {n: SilverTable(spark, os.path.join(tmp_dir, n)) for n in ("public_orders", "public_returns")}
    for q in cdc.start_table_upserts(spark, root, targets, os.path.join(tmp_dir, "ck"), available_now=True, ingest_ts="2024-02-01 00:00:00").values():
        q.awaitTermination(300)
        assert q.exception() is None
    assert state(targets["public_orders"]) == [(1, "order", 1)] and state(targets["public_returns"]) == [(1, "return", 1)]
    assert spark.read.parquet(os.path.join(tmp_dir, "public_orders_rejects")).count() == 1
    # a feed of several tables merges only the table it is started for
    mixed = SilverTable(spark, os.path.join(tmp_dir, "mixed"))
    q = cdc.start_silver_upsert(cdc.cdc_stream(spark, root, ["public_orders", "public_returns"]), mixed, os.path.join(tmp_dir, "ck2"),
                                available_now=True, ingest_ts="2024-02-01 00:00:00")
    q.awaitTermination(300)
    assert state(mixed) == [(1, "order", 1)]


def test_appended_rows_are_read(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders.parquet")
    spark.range(10).write.parquet(path)
    assert fx.read_table(spark, tmp_dir, "orders").count() == 10
    spark.range(10).write.mode("append").parquet(path)
    assert fx.read_table(spark, tmp_dir, "orders").count() == 20


@pytest.mark.parametrize("change", [{"aligner": "ALIGN_PERCENTILE_90"}, {"reducer": "REDUCE_PERCENTILE_99"}, {"comparison": "ABOVE"}])
def test_unknown_names_in_specs_are_refused(spark, change):
    policy = PL.Policy(**({"policy_id": "p", "name": "n", "signal": "s", "kind": "threshold"} | change))
    with pytest.raises(ValueError, match="unknown"):
        PL.policy_table(spark, [policy])


def test_pair_count_beyond_64_bits(spark):
    n = 10**10
    per_key = spark.createDataFrame([(1,), (2,)], "k int")
    assert audit.count_pairs(per_key, "k").first()["pair_count"] == 2
    assert "decimal" in str(audit.count_pairs(per_key, "k").schema["pair_count"].dataType).lower() and n * n < 10**38


def test_below_policies_report_their_lowest_value_and_only_named_series(spark):
    ts = [dt.datetime(2024, 1, 1, 0, 5 * k) for k in range(6)]
    health = [("h", {"r": "x"}, t, v) for t, v in zip(ts, (1.0, 0.5, 0.25, 0.75, 1.0, 1.0))]
    uploads = [("u", {"dataset_id": d}, ts[0], 1.0) for d in ("mine", "other")]
    points = spark.createDataFrame([*health, *uploads], "metric string, labels map<string,string>, ts timestamp_ntz, value double")
    below = PL.Policy("low", "n", "h", "threshold", aligner="ALIGN_MEAN", comparison="COMPARISON_LT", threshold=1.0)
    fresh = PL.Policy("fresh", "n", "u", "absent", duration_s=600, expected=({"dataset_id": "mine"},), label_any={"dataset_id": ("mine",)})
    out = PL.evaluate_policies(points, [below, fresh], dt.datetime(2024, 1, 1, 2), since=dt.datetime(2024, 1, 1))
    rows = out["episodes"].collect()
    assert [r["peak_value"] for r in rows if r["spec_id"] == "low"] == [0.25]
    assert {tuple(e["value"] for e in r["series_key"]) for r in rows if r["spec_id"] == "fresh"} == {("mine",)}
    assert series.SPEC_REDUCERS >= {"NONE"}


def test_policy_plans_read_the_aligned_series_only(spark):
    points = fx.monitoring_points(spark, "/root/testdata/sf0.001")
    policies = PL.monitoring_policies(fx.ENV_NAME, fx.STREAM_IDS, fx.DATASETS)
    out = PL.evaluate_policies(points, policies, dt.datetime(2024, 2, 1), since=dt.datetime(2024, 1, 1))
    for name in ("episodes", "notifications"):
        plan = out[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "event_type" not in plan and "props" not in plan
    series_plan = PL.policy_series(points, policies, PL.policy_table(spark, policies))._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= len(re.findall(r"\bRelation \[", series_plan)) <= 3  # events as signals, as log entries and as jobs, once each


def test_exact_percentile_of_a_hot_window_equals_the_buffered_one(spark):
    hot = spark.range(30_000).selectExpr("'m' metric", "map('k', if(id % 3 = 0, 'a', 'b')) labels", "timestamp_ntz '2024-01-01 00:01:00' ts",
                                         "cast(if(id % 7 = 0, null, (id * 7919) % 10007) as double) / 8 value")
    odd = spark.createDataFrame([("m", {"k": "c"}, dt.datetime(2024, 1, 1), None), ("m", {"k": "d"}, dt.datetime(2024, 1, 1), 2.5)], hot.schema)
    points = hot.unionByName(odd)
    got = {r["labels"]["k"]: (r["value"], r["point_count"]) for r in series.align(points, 300, "ALIGN_PERCENTILE_99").collect()}
    want = points.groupBy(F.col("labels")["k"].alias("k")).agg(F.percentile("value", F.lit(0.99)).alias("v"), F.count(F.lit(1)).alias("n")).collect()
    assert len(got) == 4 and got == {r["k"]: (pytest.approx(r["v"]) if r["v"] is not None else None, r["n"]) for r in want}
