"""Change records and backfill handoff: any interleaving gives the state of the ordered log."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import changes
from ledgerwatch.sources.contracts import BUSINESS_COLUMNS, RAW_ORDERS
from ledgerwatch.sources.tables import SilverTable
from ledgerwatch.streaming import cdc

DAY = dt.datetime(2024, 1, 1)
DDL = ("order_id long, customer_id long, product string, quantity long, unit_price int, total_price int, status string, region string, "
       "created_at timestamp_ntz, updated_at timestamp_ntz")


def rows(spark, some):
    """(order_id, version)"""
    full = [(o, 1, "p", 1, 1, 1, f"v{v}", "r", DAY, DAY + dt.timedelta(minutes=v)) for o, v in some]
    df = spark.createDataFrame(full, DDL)
    return df.select([F.col(f.name).cast(f.dataType) for f in RAW_ORDERS.fields])


def log_events(spark, log):
    """(position, order_id, operation): a row's version is its position."""
    at = rows(spark, [(o, p) for p, o, _ in log]).withColumn("p", F.substring("status", 2, 9).cast("long"))
    ops = {p: op for p, _, op in log}
    op = F.create_map(*[F.lit(x) for kv in ops.items() for x in kv])[F.col("p")]
    return changes.events(at, op, F.col("p"))


def state_at(log, position, start=0):
    out = {}
    for p, o, op in log:
        if p <= position:
            out[o] = None if op == "delete" else p
    return {o: p for o, p in out.items() if p is not None}


@pytest.mark.parametrize("seed", range(3))
def test_any_interleaving_gives_the_state_of_the_log(spark, tmp_dir, seed):
    rng = random.Random(seed)
    log, alive = [], set()
    for p in range(1, 61):
        o = rng.randrange(12)
        op = "insert" if o not in alive else rng.choice(["update", "update", "delete"])
        (alive.discard if op == "delete" else alive.add)(o)
        log.append((p, o, op))
    start, batches = 20, []
    feed = [e for e in log if e[0] > start]
    for k in range(3):  # chunks by key, each read at some point of its window
        low = start + 8 * k
        seen = state_at(log, rng.randint(low, low + 10))
        batches.append(changes.chunk(rows(spark, [(o, p) for o, p in seen.items() if o % 3 == k]), low, low + 10))
    rng.shuffle(feed)
    batches += [log_events(spark, feed[k::4]) for k in range(4)]
    batches.append(batches[-1])  # a replay
    rng.shuffle(batches)
    replica = changes.ReplicaTable(spark, os.path.join(tmp_dir, "replica"), rows_per_file=3)
    for b in batches:
        replica.apply(b)
    assert {r["order_id"]: r["status"] for r in replica.current().collect()} == {o: f"v{p}" for o, p in state_at(log, 60).items()}


def test_old_snapshot_rows_and_replayed_events_do_not_win(spark, tmp_dir):
    replica = changes.ReplicaTable(spark, os.path.join(tmp_dir, "replica"))
    replica.apply(log_events(spark, [(10, 1, "update"), (11, 2, "delete")]))
    replica.apply(changes.chunk(rows(spark, [(1, 5), (2, 5), (3, 5)]), 8, 12))  # read before the events reached it
    assert {r["order_id"]: r["status"] for r in replica.current().collect()} == {1: "v10", 3: "v5"}
    before = replica.latest()
    again = replica.apply(log_events(spark, [(10, 1, "update")]))
    assert again.version == before and again.changed.count() == 1  # reported again, written once
    assert replica.apply(log_events(spark, [(7, 3, "update")])).changed.count() == 0  # older than the chunk's row
    replica.apply(changes.chunk(rows(spark, [(1, 12)]), 10, 12))  # a chunk stands behind an event at its low end
    assert replica.current().filter("order_id = 1").first()["status"] == "v12"


def test_backfill_reads_key_ranges_between_noted_positions(spark):
    position = iter(range(100, 200, 10))
    got = list(changes.chunks(lambda: rows(spark, [(o, 1) for o in (1, 4, 5, 9)] + [(None, 1)]), lambda: next(position), [5, 8]))
    assert [sorted((r["order_id"], r["_low"], r["_high"]) for r in c.filter("order_id is not null").collect()) for c in got] == [
        [(1, 100, 110), (4, 100, 110)], [(5, 120, 130)], [(9, 140, 150)]]
    assert sum(c.count() for c in got) == 5
    records = got[0].unionByName(got[2])
    assert [tuple(changes.handed_off(records, p).first()) for p in (149, 150)] == [(150, False), (150, True)]
    with pytest.raises(ValueError):
        changes.chunk(rows(spark, []), 2, 1)


def test_records_without_place_or_operation_raise(spark):
    bad = changes.events(rows(spark, [(1, 1)]), F.lit("upsert"), F.lit(1))
    with pytest.raises(Exception, match="not a change record"):
        changes.latest_records(bad).collect()
    with pytest.raises(Exception, match="not a change record"):
        changes.latest_records(changes.events(rows(spark, [(1, 1)]), F.lit("insert"), F.lit(None))).collect()


def test_feed_of_chunks_and_events_reaches_silver(spark, tmp_dir):
    root = os.path.join(tmp_dir, "feed")
    log_events(spark, [(10, 1, "update"), (11, 2, "delete"), (12, 3, "insert")]).write.parquet(root)
    changes.chunk(rows(spark, [(1, 5), (4, 5)]), 8, 12).write.mode("append").parquet(root)
    replica = changes.ReplicaTable(spark, os.path.join(tmp_dir, "replica"))
    silver = SilverTable(spark, os.path.join(tmp_dir, "silver"))
    stream = spark.readStream.schema(changes.CHANGES).option("maxFilesPerTrigger", 1).parquet(root)
    q = cdc.start_change_feed(stream, replica, silver, os.path.join(tmp_dir, "ck"), available_now=True, ingest_ts="2024-02-01 00:00:00")
    q.awaitTermination(300)
    assert q.exception() is None
    assert sorted((r["order_id"], r["status"]) for r in silver.read().select(*BUSINESS_COLUMNS).collect()) == [(1, "v10"), (3, "v12"), (4, "v5")]
