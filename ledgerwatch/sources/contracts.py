"""Fixed data contracts (schemas) of the pipeline.

Times are UTC wall-clock ``timestamp_ntz``: the session time zone is pinned to
UTC and the stored tables carry no zone, so no implicit shift ever happens.
Money is ``decimal(18,2)``; every business column of SILVER is NOT NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TS = T.TimestampNTZType()

# Business columns in contract order (source table and SILVER share them).
ORDER_KEY = "order_id"
BUSINESS_COLUMNS = [
    "order_id", "customer_id", "product", "quantity", "unit_price",
    "total_price", "status", "region", "created_at", "updated_at",
]
# Columns a newer version overwrites on a matched key (created_at and _source stay).
UPDATE_COLUMNS = [
    "customer_id", "product", "quantity", "unit_price", "total_price",
    "status", "region", "updated_at",
]
NOT_NULL_COLUMNS = list(BUSINESS_COLUMNS)

RAW_ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("unit_price", MONEY),
    T.StructField("total_price", MONEY),
    T.StructField("status", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("created_at", TS),
    T.StructField("updated_at", TS),
])

SILVER_ORDERS = T.StructType(
    [T.StructField(f.name, f.dataType, False) for f in RAW_ORDERS.fields] + [
        T.StructField("_ingested_at", TS),
        T.StructField("_source", T.StringType()),
        T.StructField("order_date", T.DateType()),   # partition column = DATE(created_at)
    ])
SILVER_PARTITION = "order_date"
SILVER_CLUSTER = ["region", "status"]
DEFAULT_SOURCE = "datastream_cdc"

JOB_LOG = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("project_id", T.StringType()),
    T.StructField("user_email", T.StringType()),
    T.StructField("job_type", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("creation_time", TS),
    T.StructField("end_time", TS),
    T.StructField("total_slot_ms", T.LongType()),
    T.StructField("total_bytes_processed", T.LongType()),
    T.StructField("total_bytes_billed", T.LongType()),
    T.StructField("query", T.StringType()),
])

TABLE_STORAGE = T.StructType([
    T.StructField("table_schema", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("total_logical_bytes", T.LongType()),
    T.StructField("total_physical_bytes", T.LongType()),
])

LOG_ENTRIES = T.StructType([
    T.StructField("resource_type", T.StringType()),
    T.StructField("resource_labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("severity", T.StringType()),
    T.StructField("ts", TS),
    T.StructField("text_payload", T.StringType()),
    T.StructField("method_name", T.StringType()),
    T.StructField("resource_name", T.StringType()),
])

# Body of the structured failure record (15 fields), all strings except the tries.
FAILURE_RECORD = T.StructType([
    T.StructField("alert_type", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("dag_id", T.StringType()),
    T.StructField("task_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("try_number", T.LongType()),
    T.StructField("max_tries", T.LongType()),
    T.StructField("execution_date", T.StringType()),
    T.StructField("log_url", T.StringType()),
    T.StructField("exception", T.StringType()),
    T.StructField("previous_state", T.StringType()),
    T.StructField("operator", T.StringType()),
    T.StructField("duration", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

METRIC_POINTS = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("resource_type", T.StringType()),
    T.StructField("resource_labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("ts", TS),
    T.StructField("value", T.DoubleType()),
])
