"""Sources and sinks: typed scan (S1), mart and report overwrite (S9, S10),
JSON report document (S13)."""
import glob
import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerwatch.operators import marts, report, upsert
from ledgerwatch.sources import fixtures as fx
from ledgerwatch.sources import tables
from ledgerwatch.sources.contracts import RAW_ORDERS


def test_read_typed_keeps_the_contract(spark, tmp_dir):
    raw = upsert.cast_projection(fx.raw_orders(spark, SF_SMALL, lineage=False))
    path = os.path.join(tmp_dir, "raw")
    # a file that drops one contract column and carries one extra column
    raw.drop("region").withColumn("junk", F.lit(1)).write.parquet(path)
    df = tables.read_typed(spark, path, RAW_ORDERS)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in RAW_ORDERS]
    assert df.filter(F.col("region").isNotNull()).count() == 0
    assert df.count() == raw.count()


def _summary(spark):
    silver = fx.silver_merged(spark, SF_SMALL)
    rev = marts.revenue_by_product(silver)
    st = marts.order_status_summary(silver)
    return report.report_summary(report.silver_quality(silver, fx.REPORT_AS_OF), report.revenue_top(rev, 10),
                                 report.status_distribution(st), fx.REPORT_DATE, fx.PROJECT_ID)


def test_json_report_document(spark, tmp_dir):
    summary = _summary(spark)
    row = summary.collect()[0]
    path = os.path.join(tmp_dir, "report_json")
    tables.write_json_report(report.summary_json(summary, "2002-01-01T01:00:00"), path)
    lines = [ln for f in sorted(glob.glob(os.path.join(path, "part-*"))) for ln in open(f) if ln.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    assert doc["report_date"] == fx.REPORT_DATE and doc["project_id"] == fx.PROJECT_ID
    assert doc["data_quality"]["total_rows"] == row.total_rows
    assert doc["data_quality"]["freshness_ok"] == row.freshness_ok
    assert abs(doc["revenue"]["total_revenue"] - row.top_total_revenue) < 1e-6
    assert doc["revenue"]["top_product"] == row.top_product
    assert doc["status_distribution"] == json.loads(row.status_distribution)


def test_report_and_mart_writes_replace(spark, tmp_dir):
    rev = marts.revenue_by_product(fx.silver_merged(spark, SF_SMALL))
    mart_path = os.path.join(tmp_dir, "revenue_by_product")
    marts.write_mart(rev, mart_path, partition_by="order_date")
    assert spark.read.parquet(mart_path).count() == rev.count()
    one_region = rev.filter(F.col("region") == rev.select(F.min("region")).first()[0])
    marts.write_mart(one_region, mart_path, partition_by="order_date")
    assert spark.read.parquet(mart_path).count() == one_region.count()

    rep_path = os.path.join(tmp_dir, "storage_report")
    tables.write_report(rev.groupBy("region").count(), rep_path)
    tables.write_report(one_region.groupBy("region").count(), rep_path)
    assert spark.read.parquet(rep_path).count() == 1


def test_jdbc_reads_are_split_on_known_bounds():
    import pytest

    o = tables.jdbc_options("jdbc:x", "orders", {"user": "u"}, "order_id", 1, 900, 8)
    assert o == {"url": "jdbc:x", "dbtable": "orders", "fetchsize": "10000", "user": "u", "partitionColumn": "order_id", "lowerBound": "1",
                 "upperBound": "900", "numPartitions": "8"}
    assert "numPartitions" not in tables.jdbc_options("jdbc:x", "orders")
    for bad in ({"partitions": 4}, {"partitions": 4, "partition_column": "k", "lower": 1}, {"partitions": 0},
                {"partitions": 2, "partition_column": "k", "lower": 5, "upper": 1}):
        with pytest.raises(ValueError):
            tables.jdbc_options("jdbc:x", "orders", **bad)
    assert tables.jdbc_bounds_query("orders", "order_id") == "(SELECT MIN(order_id) AS low, MAX(order_id) AS high FROM orders) AS bounds"
