"""Report edge cases (empty table, invalid rows) and audit operators."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerwatch.operators import audit, marts, report, upsert
from ledgerwatch.sources.contracts import SILVER_ORDERS

T0 = dt.datetime(2024, 1, 1, 10, 0)


def silver(spark, rows):
    full = [r + (T0, "datastream_cdc", r[8].date()) for r in rows]
    return spark.createDataFrame(full, SILVER_ORDERS)


def row(oid, product="widget", status="pending", price="10.00", upd=30):
    return (oid, 1, product, 1, Decimal("1.00"), Decimal(price), status, "emea", T0,
            T0 + dt.timedelta(minutes=upd))


def test_empty_table_is_not_fresh(spark):
    dq = report.with_freshness(report.silver_quality(upsert.empty_silver(spark), "2024-01-01 00:00:00")).first()
    assert dq["total_rows"] == 0 and dq["minutes_since_last_ingest"] is None and dq["freshness_ok"] is False


def test_quality_counts_invalid_rows(spark):
    rows = [row(1, product=""), row(2, price="0.00"), row(3, price="-1.00"), row(4, status="")]
    dq = report.silver_quality(silver(spark, rows), T0 + dt.timedelta(minutes=61)).first()
    assert (dq["empty_products"], dq["invalid_prices"], dq["empty_statuses"]) == (1, 2, 1)
    assert dq["minutes_since_last_ingest"] == 61
    assert report.with_freshness(report.silver_quality(silver(spark, rows), T0 + dt.timedelta(minutes=61))) \
        .first()["freshness_ok"] is False


def test_cancelled_only_gives_empty_revenue_and_summary_defaults(spark):
    s = silver(spark, [row(1, status="cancelled"), row(2, status="cancelled")])
    rev = marts.revenue_by_product(s)
    assert rev.count() == 0
    st = marts.order_status_summary(s).first()
    assert st["order_count"] == 2 and st["avg_processing_minutes"] == 30.0
    summ = report.report_summary(report.silver_quality(s, T0), report.revenue_top(rev),
                                 report.status_distribution(marts.order_status_summary(s)), "d", "p").first()
    assert summ["top_product"] == "N/A" and summ["top_total_revenue"] == 0.0
    assert summ["status_distribution"] == '{"cancelled":2}'


def test_negative_processing_minutes_truncate_toward_zero(spark):
    s = silver(spark, [row(1, upd=-90), row(2, upd=-91)])
    st = marts.order_status_summary(s).first()
    assert st["avg_processing_minutes"] == -90.5


def test_count_pairs_matches_brute_force(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,), (3,), (3,)], "k long")
    brute = df.alias("a").crossJoin(df.alias("b")).filter(F.col("a.k") != F.col("b.k")).count()
    assert int(audit.count_pairs(df, "k").first()["pair_count"]) == brute
    empty = spark.createDataFrame([], "k long")
    assert int(audit.count_pairs(empty, "k").first()["pair_count"]) == 0


def test_storage_zero_logical_bytes(spark):
    st = spark.createDataFrame([("ds", "t1", 0, 0), ("ds2", "t", 100, 10)],
                               "table_schema string, table_name string, total_logical_bytes long, "
                               "total_physical_bytes long")
    out = {r["dataset_id"]: r for r in audit.storage_comparison(st, "2024-01-01 00:00:00").collect()}
    assert out["ds"]["compression_ratio"] is None
    assert out["ds"]["recommended_billing_model"] == "LOGICAL_CHEAPER"      # tie -> LOGICAL
    assert out["ds2"]["recommended_billing_model"] == "PHYSICAL_CHEAPER"


def test_slot_audit_threshold_is_a_parameter(spark):
    jobs = spark.createDataFrame(
        [("j1", "p", "u", "QUERY", "DONE", T0, T0, 400_000, 1, 1, "q"),
         ("j2", "p", "u", "QUERY", "DONE", T0 - dt.timedelta(hours=25), T0, 900_000_000, 1, 1, "q"),
         ("j3", "p", "u", "QUERY", "RUNNING", T0, T0, 900_000_000, 1, 1, "q")],
        "job_id string, project_id string, user_email string, job_type string, state string, "
        "creation_time timestamp_ntz, end_time timestamp_ntz, total_slot_ms long, "
        "total_bytes_processed long, total_bytes_billed long, query string")
    assert audit.slot_time_audit(jobs).count() == 0
    assert [r["job_id"] for r in audit.slot_time_audit(jobs, threshold=300).collect()] == ["j1"]
