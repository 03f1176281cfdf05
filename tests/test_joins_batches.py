"""Size-checked broadcast and the multi-batch latest-row operator."""
from pyspark.sql import functions as F

from ledgerwatch.operators import joins, upsert


def test_small_side_checks_the_estimate(spark):
    small = joins.local_table(spark, [(1, "a"), (2, "b")], "k int, v string")
    assert joins.estimated_bytes(small) < 1024
    assert joins.small_side(small) is not small          # hinted
    assert joins.small_side(small, max_bytes=0) is small  # over the bound: left to the shuffle join
    huge = spark.range(10 ** 12)
    assert joins.estimated_bytes(huge) > joins.BROADCAST_LIMIT_BYTES
    assert joins.small_side(huge) is huge


def test_small_side_plans_a_broadcast_join(spark):
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = joins.local_table(spark, [(1, "a"), (2, "b")], "k long, v string")
    plan = big.join(joins.small_side(small), "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


ROWS = [
    # key, ts, tie, payload, batch
    (1, 5, 1, "a", "x"), (1, 7, 1, "b", "x"), (1, 7, 2, "c", "y"), (1, 9, 0, "d", "y"),
    (2, 3, 0, "e", "x"), (2, 3, 0, "f", "x"),                      # whole tie -> payload decides
    (3, 1, 0, "g", "y"),                                           # only in batch y
    (4, None, 0, "h", "x"), (4, 2, 0, "i", "x"),                   # NULL order value ranks last
] + [(5, i, i % 3, f"p{i}", "x" if i % 2 else "y") for i in range(30)]  # a hot key


def test_latest_per_key_batches_matches_per_batch(spark):
    df = spark.createDataFrame(ROWS, "key long, ts long, tie long, payload string, batch string")
    batches = {"x": F.col("batch") == "x", "y": F.col("batch") == "y"}
    got = upsert.latest_per_key_batches(df, "key", ["ts", "tie"], batches)
    for name, pred in batches.items():
        want = upsert.latest_per_key(df.filter(pred), "key", ["ts", "tie"])
        assert got[name].columns == df.columns
        assert sorted(got[name].collect()) == sorted(want.collect()), name
    assert {r.key for r in got["y"].collect()} == {1, 3, 5}
    assert [r.payload for r in got["x"].filter("key = 2").collect()] == ["f"]


def test_batches_share_one_exchange(spark):
    df = spark.createDataFrame(ROWS, "key long, ts long, tie long, payload string, batch string")
    out = upsert.latest_per_key_batches(df, "key", ["ts", "tie"],
                                        {"x": F.col("batch") == "x", "y": F.col("batch") == "y"})
    j = out["x"].alias("a").join(out["y"].alias("b"), "key", "full_outer")
    j.collect()
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_local_tables_are_broadcast_without_arrow(spark):
    key = "spark.sql.execution.arrow.pyspark.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        rows = [("a", {"k": "v"}, ["x"], 1.5, [{"key": "p", "value": "q"}]), ("b", {}, [], None, [])]
        small = joins.local_table(spark, rows, "spec string, wanted map<string,string>, by array<string>, at double, key array<struct<key:string,value:string>>")
        assert joins.estimated_bytes(small) < 4096
        assert joins.small_side(small) is not small
        assert [(r.spec, r.wanted, r.by, r["at"], [e.asDict() for e in r.key]) for r in small.collect()] == rows
        assert joins.local_table(spark, [], "k int, v string").collect() == []
    finally:
        spark.conf.set(key, was)


def test_latest_rows_of_raw_need_no_exchange_of_their_own(spark):
    from ledgerwatch.sources import fixtures as fx

    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = fx.latest_orders(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, was)
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(order_id" not in plan
    assert plan.count("Exchange hashpartitioning(o_custkey") == 1 and plan.count("Exchange hashpartitioning(l_") == 2
