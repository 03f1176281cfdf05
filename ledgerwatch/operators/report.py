"""Orders report (A3-A8): data quality, top revenue, status distribution, summary.

Everything stays a DataFrame until the one-row summary; nothing is pulled to
the driver.  The report reproduces the notebook's semantics on purpose:

* Q2: A5/A6 average the per-day averages unweighted; the weighted variants
  have their own names.
* Q4: the summary's revenue total and product count cover only the top-N
  rows, so the columns are named ``top_*``.
* Q5: a NULL staleness (empty table) gives ``freshness_ok = false``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.scalar import minutes_between
from ledgerwatch.operators.upsert import _ts_literal

STALENESS_LIMIT_MINUTES = 60


def silver_quality(silver: DataFrame, as_of) -> DataFrame:
    """A3: one row of counts, NULL/invalid checks and staleness in minutes."""
    now = _ts_literal(as_of)
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("order_id").isNull()).alias("null_order_ids"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_ids"),
        F.count_if(F.col("product").isNull() | (F.col("product") == "")).alias("empty_products"),
        F.count_if(F.col("total_price").isNull() | (F.col("total_price") <= 0)).alias("invalid_prices"),
        F.count_if(F.col("status").isNull() | (F.col("status") == "")).alias("empty_statuses"),
        F.min("created_at").alias("earliest_order"),
        F.max("created_at").alias("latest_order"),
        F.max("_ingested_at").alias("last_ingestion"),
        minutes_between(F.max("_ingested_at"), now).alias("minutes_since_last_ingest"),
    )


def freshness_ok(staleness_minutes: Column | str, limit: int = STALENESS_LIMIT_MINUTES) -> Column:
    """A4: fresh when staleness <= limit; NULL staleness is not fresh (Q5)."""
    c = F.col(staleness_minutes) if isinstance(staleness_minutes, str) else staleness_minutes
    return F.coalesce(c <= F.lit(limit), F.lit(False))


def with_freshness(dq: DataFrame, limit: int = STALENESS_LIMIT_MINUTES) -> DataFrame:
    return dq.withColumn("freshness_ok", freshness_ok("minutes_since_last_ingest", limit))


def revenue_rollup(revenue_mart: DataFrame) -> DataFrame:
    """Re-aggregate the revenue mart by product and region (unweighted avg, Q2)."""
    return (revenue_mart.groupBy("product", "region")
            .agg(F.sum("order_count").alias("total_orders"),
                 F.sum("total_quantity").alias("total_quantity"),
                 F.round(F.sum("total_revenue"), 2).alias("total_revenue"),
                 F.round(F.avg("avg_order_value"), 2).alias("avg_order_value")))


def revenue_top(revenue_mart: DataFrame, n: int = 10) -> DataFrame:
    """A5: top-``n`` product/region pairs by revenue (TakeOrderedAndProject).

    The limit is the feature (a top-k report).  Ties are broken by product and
    region so the cut is deterministic.
    """
    return revenue_rollup(revenue_mart).orderBy(
        F.col("total_revenue").desc(), "product", "region").limit(n)


def revenue_top_weighted(revenue_mart: DataFrame, n: int = 10) -> DataFrame:
    """Weighted variant of A5: average order value = revenue / orders."""
    return (revenue_mart.groupBy("product", "region")
            .agg(F.sum("order_count").alias("total_orders"),
                 F.sum("total_quantity").alias("total_quantity"),
                 F.round(F.sum("total_revenue"), 2).alias("total_revenue"),
                 F.round(F.sum("total_revenue") / F.sum("order_count"), 2).alias("avg_order_value"))
            .orderBy(F.col("total_revenue").desc(), "product", "region").limit(n))


def status_distribution(status_mart: DataFrame) -> DataFrame:
    """Orders, value and (unweighted) average minutes per status."""
    return (status_mart.groupBy("status")
            .agg(F.sum("order_count").alias("total_orders"),
                 F.round(F.sum("total_value"), 2).alias("total_value"),
                 F.round(F.avg("avg_processing_minutes"), 1).alias("avg_processing_min"))
            .orderBy(F.col("total_orders").desc(), "status"))


def row_count(df: DataFrame) -> DataFrame:
    """Row count of a table as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def report_summary(dq: DataFrame, top: DataFrame, status: DataFrame,
                   report_date: str, project_id: str,
                   limit: int = STALENESS_LIMIT_MINUTES) -> DataFrame:
    """The one-row summary, flat columns plus the status map as JSON.

    The three inputs are one row, top-N rows and one row per status, so the
    combining joins are on a constant key over bounded inputs.
    """
    dq1 = dq.select(
        "total_rows", "null_order_ids", "null_customer_ids", "empty_products", "invalid_prices",
        F.coalesce(F.col("minutes_since_last_ingest").cast("double"), F.lit(0.0)).alias("minutes_since_last_ingest"),
        freshness_ok("minutes_since_last_ingest", limit).alias("freshness_ok"),
        F.lit(1).alias("_k"))
    rev = top.agg(
        F.coalesce(F.sum("total_revenue").cast("double"), F.lit(0.0)).alias("top_total_revenue"),
        F.coalesce(F.min_by("product", F.struct(F.negative(F.col("total_revenue")), F.col("product"),
                                                F.col("region"))), F.lit("N/A")).alias("top_product"),
        F.count_distinct("product").alias("top_product_count"),
        F.lit(1).alias("_k"))
    st = status.agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(
            F.struct(F.col("status"), F.col("total_orders")))))).alias("status_distribution"),
        F.lit(1).alias("_k"))
    return (dq1.join(rev, "_k", "left").join(st, "_k", "left")
            .select(F.lit(report_date).alias("report_date"), F.lit(project_id).alias("project_id"),
                    "total_rows", "null_order_ids", "null_customer_ids", "empty_products",
                    "invalid_prices", "minutes_since_last_ingest", "freshness_ok",
                    "top_total_revenue", "top_product", "top_product_count",
                    F.coalesce("status_distribution", F.lit("{}")).alias("status_distribution")))


def summary_json(summary: DataFrame, generated_at: str) -> DataFrame:
    """The summary as one nested JSON document per row."""
    return summary.select(F.to_json(F.struct(
        F.col("report_date"), F.lit(generated_at).alias("generated_at"), F.col("project_id"),
        F.struct("total_rows", "null_order_ids", "null_customer_ids", "empty_products",
                 "invalid_prices", "minutes_since_last_ingest", "freshness_ok").alias("data_quality"),
        F.struct(F.col("top_total_revenue").alias("total_revenue"), "top_product",
                 F.col("top_product_count").alias("product_count")).alias("revenue"),
        F.from_json("status_distribution", "map<string,bigint>").alias("status_distribution"),
    )).alias("summary"))
