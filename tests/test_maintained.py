"""Marts kept by signed deltas equal the full queries after every batch."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import maintained, marts
from ledgerwatch.sources.contracts import RAW_ORDERS
from ledgerwatch.sources.tables import SilverTable
from test_changes import DDL

DAY = dt.datetime(2024, 1, 1)


def raw(spark, some):
    """(order_id, product, price in cents, status, region, minutes of created_at, minutes until updated_at)"""
    full = [(o, 1, p, 2, 1, 1, s, r, DAY + dt.timedelta(minutes=c), DAY + dt.timedelta(minutes=c + u)) for o, p, _, s, r, c, u in some]
    df = spark.createDataFrame(full, DDL).withColumn("total_price", F.col("updated_at").cast("string").substr(15, 2).cast("decimal(18,2)") + F.lit(0.25).cast("decimal(18,2)"))
    return df.select([F.col(f.name).cast(f.dataType) for f in RAW_ORDERS.fields])


def equal(mart, full):
    cols = full.columns
    norm = lambda df: sorted((tuple(float(v) if hasattr(v, "as_tuple") else v for v in r) for r in df.select(*cols).collect()), key=str)
    assert norm(mart) == norm(full)


@pytest.mark.parametrize("seed", [1])
def test_marts_follow_random_batches(spark, tmp_dir, seed):
    rng = random.Random(seed)
    silver = SilverTable(spark, os.path.join(tmp_dir, "silver"), rows_per_file=20)
    revenue = maintained.MaintainedMart(spark, os.path.join(tmp_dir, "a1"), silver, maintained.revenue_definition(), rows_per_file=5)
    status = maintained.MaintainedMart(spark, os.path.join(tmp_dir, "a2"), silver, maintained.status_definition(), rows_per_file=5)
    assert revenue.refresh() == {"version": None, "rows_read": 0}
    for k in range(4):
        batch = [(o, rng.choice("ab"), 0, rng.choice(["pending", "shipped", "cancelled"]), rng.choice("xy"), (o * 97) % 4000, 100 * k + rng.randrange(90))
                 for o in (range(80) if k == 0 else rng.sample(range(100), 12))]
        silver.upsert(raw(spark, batch), "2024-02-01 00:00:00")
        for mart, full in ((revenue, marts.revenue_by_product), (status, marts.order_status_summary)):
            first = mart.refresh()
            equal(mart.mart(), full(silver.read()))
            assert mart.refresh() == {"version": first["version"], "rows_read": 0}  # nothing counts twice


def test_a_lost_minimum_is_computed_anew_and_a_batch_reads_its_part(spark, tmp_dir):
    silver = SilverTable(spark, os.path.join(tmp_dir, "silver"), rows_per_file=10)
    mart = maintained.MaintainedMart(spark, os.path.join(tmp_dir, "a1"), silver, maintained.revenue_definition())
    silver.upsert(raw(spark, [(o, "a", 0, "pending", "x", 1440 * (o // 10) + o, 5) for o in range(200)]), "2024-02-01 00:00:00")
    mart.refresh()
    silver.upsert(raw(spark, [(0, "a", 0, "cancelled", "x", 0, 9)]), "2024-02-02 00:00:00")  # the first order of its group
    out = mart.refresh()
    equal(mart.mart(), marts.revenue_by_product(silver.read()))
    assert 0 < out["rows_read"] <= 60
    silver.vacuum(keep=1)  # the shown version is known still
    silver.upsert(raw(spark, [(o, "a", 0, "cancelled", "x", o, 9) for o in range(10)]), "2024-02-03 00:00:00")  # a group goes
    mart.refresh()
    equal(mart.mart(), marts.revenue_by_product(silver.read()))
    silver.upsert(raw(spark, [(50, "b", 0, "shipped", "x", 0, 99999)]), "2024-02-04 00:00:00")
    silver.vacuum(keep=1)  # SILVER has forgotten the version the mart shows
    mart.refresh()
    equal(mart.mart(), marts.revenue_by_product(silver.read()))
