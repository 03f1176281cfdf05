"""DATAMART aggregates over SILVER (A1, A2).

Both are single hash aggregates (partial + final), so hot groups are folded
map-side.  A1 groups on the stored ``order_date`` partition column, which
equals ``DATE(created_at)``; the stored order of a table is undefined (Q6), so
sorting is left to the reader (:func:`sorted_revenue`, :func:`sorted_status`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.scalar import minutes_between


def revenue_by_product(silver: DataFrame) -> DataFrame:
    """A1: revenue per product, region and order date; cancelled orders excluded.

    ``status NOT IN ('cancelled')`` also drops NULL statuses, as in SQL (P2).
    """
    order_date = F.col("order_date") if "order_date" in silver.columns else F.to_date("created_at")
    return (silver
            .filter(~F.col("status").isin("cancelled"))
            .groupBy("product", "region", order_date.alias("order_date"))
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum("quantity").alias("total_quantity"),
                 F.round(F.sum("total_price"), 2).alias("total_revenue"),
                 F.round(F.avg("total_price"), 2).alias("avg_order_value"),
                 F.min("created_at").alias("first_order"),
                 F.max("created_at").alias("last_order")))


def order_status_summary(silver: DataFrame) -> DataFrame:
    """A2: orders per status, region and status date with average minutes
    from creation to the last update (whole minutes, truncated)."""
    return (silver
            .groupBy("status", "region", F.to_date("updated_at").alias("status_date"))
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.round(F.sum("total_price"), 2).alias("total_value"),
                 F.round(F.avg(minutes_between("created_at", "updated_at")), 1).alias("avg_processing_minutes")))


def sorted_revenue(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.col("total_revenue").desc(), "product", "region", "order_date")


def sorted_status(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.col("status_date").desc(), F.col("order_count").desc(), "status", "region")


def write_mart(mart: DataFrame, path: str, partition_by: str | None = None) -> None:
    """CREATE OR REPLACE TABLE AS SELECT -> full overwrite of the mart.

    The overwrite is static even when the session default is dynamic partition
    overwrite (used by the SILVER upsert): dates absent from the new mart must
    disappear too.
    """
    w = mart.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
