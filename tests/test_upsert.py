"""MERGE branches, NULL and tie cases, replay and order properties on hand-made rows."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerwatch.operators import upsert
from ledgerwatch.sources.contracts import RAW_ORDERS

T0 = dt.datetime(2024, 1, 1, 10, 0)


def raw_row(oid, updated_min, status="pending", price="10.00", created=T0, product="widget"):
    return (oid, 1000, product, 2, Decimal("5.00"), Decimal(price), status, "emea",
            created, created + dt.timedelta(minutes=updated_min))


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW_ORDERS)


def merged(spark, target_rows, source_rows, ts="2024-01-02 00:00:00"):
    tgt = upsert.merge_upsert(upsert.empty_silver(spark),
                              upsert.prepare_source(raw_df(spark, target_rows))[0], "2024-01-01 12:00:00",
                              with_action=False)
    src, rej = upsert.prepare_source(raw_df(spark, source_rows))
    return upsert.merge_upsert(tgt, src, ts), rej


def by_id(df):
    return {r["order_id"]: r for r in df.collect()}


def test_branches(spark):
    out, _ = merged(spark,
                    [raw_row(1, 0), raw_row(2, 10), raw_row(3, 10), raw_row(4, 0)],
                    [raw_row(1, 5, "shipped"), raw_row(2, 10, "cancelled"), raw_row(3, 5, "cancelled"),
                     raw_row(5, 0, created=T0 + dt.timedelta(days=1))])
    rows = by_id(out)
    assert rows[1]["_action"] == "updated" and rows[1]["status"] == "shipped"
    assert rows[2]["_action"] == "unchanged" and rows[2]["status"] == "pending"    # equal updated_at
    assert rows[3]["_action"] == "unchanged" and rows[3]["status"] == "pending"    # older after newer
    assert rows[4]["_action"] == "untouched"
    assert rows[5]["_action"] == "inserted" and rows[5]["_source"] == "datastream_cdc"
    assert str(rows[5]["order_date"]) == "2024-01-02"
    assert rows[1]["_ingested_at"] == dt.datetime(2024, 1, 2)
    assert rows[4]["_ingested_at"] == dt.datetime(2024, 1, 1, 12)


def test_update_keeps_created_at_and_source(spark):
    out, _ = merged(spark, [raw_row(1, 0)], [raw_row(1, 5, created=T0 + dt.timedelta(days=3))])
    r = by_id(out)[1]
    assert r["_action"] == "updated" and r["created_at"] == T0 and r["_source"] == "datastream_cdc"


def test_null_key_goes_to_rejects(spark):
    bad = (None, 1000, "w", 1, Decimal("1.00"), Decimal("1.00"), "pending", "emea", T0, T0)
    out, rej = merged(spark, [raw_row(1, 0)], [bad, raw_row(2, 0)])
    assert set(by_id(out)) == {1, 2}
    reasons = [r["_reject_reason"] for r in rej.collect()]
    assert reasons == ["null:order_id"]


def test_latest_per_key_tie_break_and_methods(spark):
    rows = [raw_row(1, 5, "a"), raw_row(1, 5, "b"), raw_row(1, 3, "z"), raw_row(2, 1), raw_row(2, 1)]
    df = raw_df(spark, rows)
    agg = by_id(upsert.latest_per_key(df, "order_id", ["updated_at"]))
    win = by_id(upsert.latest_per_key(df, "order_id", ["updated_at"], method="window"))
    assert agg[1]["status"] == "b" and win[1]["status"] == "b"
    assert agg == win


def test_replay_is_idempotent_and_order_free(spark):
    batch_a = [raw_row(1, 5, "shipped"), raw_row(2, 1)]
    batch_b = [raw_row(1, 9, "delivered"), raw_row(3, 0)]
    base = upsert.merge_upsert(upsert.empty_silver(spark), upsert.prepare_source(raw_df(spark, [raw_row(1, 0)]))[0],
                               "2024-01-01 00:00:00", with_action=False)

    def apply(tgt, rows, ts):
        return upsert.merge_upsert(tgt, upsert.prepare_source(raw_df(spark, rows))[0], ts, with_action=False)

    once = apply(apply(base, batch_a, "2024-01-02 00:00:00"), batch_b, "2024-01-03 00:00:00")
    twice = apply(once, batch_b, "2024-01-04 00:00:00")
    swapped = apply(apply(base, batch_b, "2024-01-02 00:00:00"), batch_a, "2024-01-03 00:00:00")
    cols = [c for c in once.columns if c != "_ingested_at"]
    assert sorted(once.select(cols).collect()) == sorted(twice.select(cols).collect())
    assert sorted(once.select(cols).collect()) == sorted(swapped.select(cols).collect())
    assert by_id(twice)[1]["_ingested_at"] == dt.datetime(2024, 1, 3)


def test_cast_projection_safe_mode(spark):
    df = spark.createDataFrame([("1", "x")], "order_id string, customer_id string")
    for f in RAW_ORDERS.fields[2:]:
        df = df.withColumn(f.name, F.lit(None).cast("string"))
    out = upsert.cast_projection(df, safe=True).first()
    assert out["order_id"] == 1 and out["customer_id"] is None
