"""DuckDB oracle SQL for the registered queries.

Each string runs on the pre-registered views of the test tables and derives
the pipeline inputs with the same rules as ``ledgerwatch.sources.fixtures``,
written independently in SQL.  Decimal and floating outputs are compared as
``round(CAST(x AS DOUBLE), 6)`` on both sides (see ``plans.catalog.finish``).
"""

from __future__ import annotations

from ledgerwatch.sources.fixtures import (
    HEALTH_THRESHOLD,
    INCOMING_INGEST_TS,
    PROJECT_ID,
    REPORT_AS_OF,
    REPORT_DATE,
    SEED_INGEST_TS,
    UPDATED_AT_EPOCH,
)


def wrap(sql: str, columns: list[str], fractional: list[str] = ()) -> str:
    """Outer projection: fractional columns as ``round(double, 6)``."""
    frac = set(fractional)
    sel = ",\n  ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" if c in frac else c for c in columns)
    return f"SELECT\n  {sel}\nFROM (\n{sql}\n) q"


# --------------------------------------------------------------------------- orders

RAW_CTE = f"""
raw AS (
  SELECT l.l_orderkey AS order_id,
         o.o_custkey AS customer_id,
         p.p_name AS product,
         CAST(l.l_quantity AS BIGINT) AS quantity,
         CAST(p.p_retailprice AS DECIMAL(18,2)) AS unit_price,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_price,
         CASE WHEN l.l_returnflag = 'R' THEN 'cancelled'
              WHEN l.l_returnflag = 'A' THEN 'delivered'
              WHEN l.l_linestatus = 'O' THEN 'pending'
              WHEN l.l_linestatus = 'F' THEN 'shipped' END AS status,
         r.r_name AS region,
         CAST(o.o_orderdate AS TIMESTAMP) AS created_at,
         CAST(o.o_orderdate AS TIMESTAMP)
           + to_minutes(CAST(date_diff('day', DATE '{UPDATED_AT_EPOCH}', CAST(l.l_shipdate AS DATE)) AS BIGINT))
           AS updated_at,
         l.l_partkey, l.l_suppkey, l.l_linenumber
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

BUSINESS = ("order_id, customer_id, product, quantity, unit_price, total_price, status, region, "
            "created_at, updated_at")
_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in BUSINESS.split(", "))
_LATEST_ORDER = ("updated_at DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC, total_price DESC, "
                 "customer_id DESC, product DESC, quantity DESC, unit_price DESC, status DESC, "
                 "region DESC, created_at DESC")


def latest_cte(name: str, where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT {BUSINESS} FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {_LATEST_ORDER}) AS rn
    FROM raw WHERE {_NOT_NULL} AND ({where})
  ) x WHERE rn = 1
)"""


def _merge_cte() -> str:
    upd = ["customer_id", "product", "quantity", "unit_price", "total_price", "status", "region", "updated_at"]
    act = ("CASE WHEN t.order_id IS NULL THEN 'inserted' WHEN s.order_id IS NULL THEN 'untouched' "
           "WHEN s.updated_at > t.updated_at THEN 'updated' ELSE 'unchanged' END")
    cols = [f"CASE WHEN a IN ('inserted','updated') THEN s_{c} ELSE t_{c} END AS {c}" for c in upd]
    return f"""
seed_silver AS (
  SELECT {BUSINESS}, TIMESTAMP '{SEED_INGEST_TS}' AS _ingested_at, 'datastream_cdc' AS _source
  FROM seed_latest
),
joined AS (
  SELECT COALESCE(t.order_id, s.order_id) AS order_id, {act} AS a,
         {", ".join(f"t.{c} AS t_{c}" for c in BUSINESS.split(", ")[1:])},
         t._ingested_at AS t__ingested_at, t._source AS t__source,
         {", ".join(f"s.{c} AS s_{c}" for c in BUSINESS.split(", ")[1:])}
  FROM seed_silver t FULL OUTER JOIN incoming_latest s ON t.order_id = s.order_id
),
merged AS (
  SELECT order_id,
         {", ".join(cols[:7])},
         CASE WHEN a = 'inserted' THEN s_created_at ELSE t_created_at END AS created_at,
         {cols[7]},
         CASE WHEN a IN ('inserted','updated') THEN TIMESTAMP '{INCOMING_INGEST_TS}' ELSE t__ingested_at END
           AS _ingested_at,
         CASE WHEN a = 'inserted' THEN 'datastream_cdc' ELSE t__source END AS _source,
         CAST(CASE WHEN a = 'inserted' THEN s_created_at ELSE t_created_at END AS DATE) AS order_date,
         a AS _action
  FROM joined
)"""


ORDERS_CTES = ("WITH " + RAW_CTE + "," + latest_cte("seed_latest", "l_linenumber % 2 = 1") + ","
               + latest_cte("incoming_latest", "l_linenumber % 2 = 0") + "," + _merge_cte())
SILVER = "(SELECT * EXCLUDE (_action) FROM merged)"

REVENUE_MART = f"""
SELECT product, region, order_date,
       COUNT(*) AS order_count,
       CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       ROUND(SUM(total_price), 2) AS total_revenue,
       ROUND(SUM(total_price) / COUNT(total_price), 2) AS avg_order_value,
       MIN(created_at) AS first_order,
       MAX(created_at) AS last_order
FROM {SILVER} s
WHERE status NOT IN ('cancelled')
GROUP BY product, region, order_date"""

STATUS_MART = f"""
SELECT status, region, CAST(updated_at AS DATE) AS status_date,
       COUNT(*) AS order_count,
       ROUND(SUM(total_price), 2) AS total_value,
       ROUND(AVG(date_sub('minute', created_at, updated_at)), 1) AS avg_processing_minutes
FROM {SILVER} s
GROUP BY status, region, CAST(updated_at AS DATE)"""

REVENUE_TOP = f"""
SELECT product, region,
       CAST(SUM(order_count) AS BIGINT) AS total_orders,
       CAST(SUM(total_quantity) AS BIGINT) AS total_quantity,
       ROUND(SUM(total_revenue), 2) AS total_revenue,
       ROUND(SUM(avg_order_value) / COUNT(avg_order_value), 2) AS avg_order_value
FROM ({REVENUE_MART}) m
GROUP BY product, region
ORDER BY total_revenue DESC, product, region
LIMIT 10"""

STATUS_DIST = f"""
SELECT status,
       CAST(SUM(order_count) AS BIGINT) AS total_orders,
       ROUND(SUM(total_value), 2) AS total_value,
       ROUND(AVG(avg_processing_minutes), 1) AS avg_processing_min
FROM ({STATUS_MART}) m
GROUP BY status"""

SILVER_QUALITY = f"""
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE order_id IS NULL) AS null_order_ids,
       COUNT(*) FILTER (WHERE customer_id IS NULL) AS null_customer_ids,
       COUNT(*) FILTER (WHERE product IS NULL OR product = '') AS empty_products,
       COUNT(*) FILTER (WHERE total_price IS NULL OR total_price <= 0) AS invalid_prices,
       COUNT(*) FILTER (WHERE status IS NULL OR status = '') AS empty_statuses,
       MIN(created_at) AS earliest_order,
       MAX(created_at) AS latest_order,
       MAX(_ingested_at) AS last_ingestion,
       date_sub('minute', MAX(_ingested_at), TIMESTAMP '{REPORT_AS_OF}') AS minutes_since_last_ingest
FROM {SILVER} s"""

REPORT_SUMMARY = f"""
SELECT '{REPORT_DATE}' AS report_date, '{PROJECT_ID}' AS project_id,
       dq.total_rows, dq.null_order_ids, dq.null_customer_ids, dq.empty_products, dq.invalid_prices,
       COALESCE(CAST(dq.minutes_since_last_ingest AS DOUBLE), 0.0) AS minutes_since_last_ingest,
       COALESCE(dq.minutes_since_last_ingest <= 60, FALSE) AS freshness_ok,
       COALESCE(CAST(rv.top_total_revenue AS DOUBLE), 0.0) AS top_total_revenue,
       COALESCE(rv.top_product, 'N/A') AS top_product,
       rv.top_product_count,
       COALESCE(st.status_distribution, '{{}}') AS status_distribution
FROM ({SILVER_QUALITY}) dq
CROSS JOIN (
  SELECT SUM(total_revenue) AS top_total_revenue,
         arg_min(product, (-total_revenue, product, region)) AS top_product,
         COUNT(DISTINCT product) AS top_product_count
  FROM ({REVENUE_TOP}) t) rv
CROSS JOIN (
  SELECT CAST(to_json(map_from_entries(list((status, total_orders) ORDER BY status))) AS VARCHAR)
         AS status_distribution
  FROM ({STATUS_DIST}) d) st"""


def merged_query(body: str) -> str:
    return ORDERS_CTES + "\n" + body


# --------------------------------------------------------------------------- audits

JOB_LOG = f"""
job_log AS (
  SELECT 'job_' || CAST(event_id AS VARCHAR) AS job_id,
         '{PROJECT_ID}' AS project_id,
         'user' || CAST(user_id AS VARCHAR) || '@example.com' AS user_email,
         'QUERY' AS job_type,
         CASE WHEN event_type = 'error' THEN 'RUNNING' ELSE 'DONE' END AS state,
         ts AS creation_time,
         ts + to_seconds(CAST(trunc(value) AS BIGINT)) AS end_time,
         CAST(trunc(value * 1e7) AS BIGINT) AS total_slot_ms,
         CAST(trunc(value * 1e9) AS BIGINT) AS total_bytes_processed,
         CAST(ceil(CAST(trunc(value * 1e9) AS BIGINT) / 10485760.0) AS BIGINT) * 10485760 AS total_bytes_billed,
         'SELECT ' || props AS query
  FROM events
)"""

SLOT_AUDIT = f"""
WITH {JOB_LOG}
SELECT job_id, project_id, user_email, job_type, state, creation_time, end_time,
       total_slot_ms / 1000 AS total_slot_seconds, total_bytes_processed, total_bytes_billed, query
FROM job_log
WHERE creation_time >= (SELECT MAX(creation_time) FROM job_log) - INTERVAL 24 HOUR
  AND state = 'DONE'
  AND total_slot_ms / 1000 > 86400"""

STORAGE = f"""
WITH table_storage AS (
  SELECT source AS table_schema, 'doc_' || CAST(doc_id AS VARCHAR) AS table_name,
         CAST(n_chars AS BIGINT) AS total_logical_bytes,
         CAST((n_chars * (1 + length(source) % 4)) // 4 AS BIGINT) AS total_physical_bytes
  FROM documents
)
SELECT TIMESTAMP '{REPORT_AS_OF}' AS snapshot_time,
       table_schema AS dataset_id,
       COUNT(*) AS table_count,
       CAST(SUM(total_logical_bytes) AS BIGINT) AS total_logical_bytes,
       CAST(SUM(total_physical_bytes) AS BIGINT) AS total_physical_bytes,
       CASE WHEN SUM(total_logical_bytes) = 0 THEN NULL
            ELSE CAST(SUM(total_physical_bytes) AS DOUBLE) / CAST(SUM(total_logical_bytes) AS DOUBLE) END
         AS compression_ratio,
       SUM(total_logical_bytes) / POW(1024, 3) * 0.02 AS est_monthly_cost_logical,
       SUM(total_physical_bytes) / POW(1024, 3) * 0.04 AS est_monthly_cost_physical,
       CASE WHEN SUM(total_physical_bytes) / POW(1024, 3) * 0.04 < SUM(total_logical_bytes) / POW(1024, 3) * 0.02
            THEN 'PHYSICAL_CHEAPER' ELSE 'LOGICAL_CHEAPER' END AS recommended_billing_model
FROM table_storage
GROUP BY table_schema"""

PAIR_COUNT = merged_query(
    ", s AS MATERIALIZED (SELECT order_id FROM merged)\n"
    "SELECT CAST(COUNT(*) AS DOUBLE) AS pair_count FROM s a CROSS JOIN s b WHERE a.order_id <> b.order_id")

# --------------------------------------------------------------------------- logs

def _pick(values: list[str], idx: str) -> str:
    return "list_value(" + ", ".join(f"'{v}'" for v in values) + f")[({idx}) % {len(values)} + 1]"


def log_entries_cte() -> str:
    from ledgerwatch.sources.fixtures import DAG_IDS, ENV_NAME, RESOURCE_TYPES, TASK_IDS, TRANSFER_METHOD
    rt = _pick(RESOURCE_TYPES, "user_id")
    dag = _pick(DAG_IDS, "event_id")
    task = _pick(TASK_IDS, "user_id")
    tss = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"
    body = (f"""'{{"alert_type": "TASK_FAILURE", "source": "global_listener", "message": "Task ' || {task} """
            f"""|| ' in DAG ' || {dag} || ' failed", "dag_id": "' || {dag} || '", "task_id": "' || {task} """
            f"""|| '", "run_id": "scheduled__' || {tss} || '", "try_number": ' || CAST(event_id % 3 + 1 AS VARCHAR) """
            f"""|| ', "max_tries": 2, "execution_date": "' || {tss} || '", "log_url": "", "exception": "value ' """
            f"""|| CAST(value AS VARCHAR) || '", "previous_state": "running", "operator": "PythonOperator", """
            f""""duration": "' || CAST(value AS VARCHAR) || '", "timestamp": "' || {tss} || '"}}'""")
    return f"""
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, {rt} AS rtype FROM events),
log_entries AS (
  SELECT rtype AS resource_type,
         CASE WHEN rtype = '{RESOURCE_TYPES[0]}' THEN MAP {{'environment_name': '{ENV_NAME}'}}
              WHEN rtype = '{RESOURCE_TYPES[2]}' THEN MAP {{'stream_id': 'orders-stream-' || CAST(user_id % 4 AS VARCHAR)}}
              ELSE MAP {{'project_id': '{PROJECT_ID}'}} END AS resource_labels,
         CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'WARNING' ELSE 'INFO' END
           AS severity,
         ts,
         CASE WHEN rtype = '{RESOURCE_TYPES[0]}' THEN
                CASE WHEN k < 20 THEN 'DagBag import_errors while parsing dag ' || {dag}
                     WHEN event_type = 'error' THEN {body}
                     ELSE 'Task ' || {task} || ' heartbeat' END
              WHEN rtype = '{RESOURCE_TYPES[2]}' THEN
                CASE WHEN k < 30 THEN 'Backfill failed for public.orders chunk ' || CAST(k AS VARCHAR)
                     ELSE 'stream read batch ' || CAST(k AS VARCHAR) END
              ELSE 'job ' || CAST(event_id AS VARCHAR) END AS text_payload,
         CASE WHEN rtype = '{RESOURCE_TYPES[1]}' AND k < 50 THEN '{TRANSFER_METHOD}'
              WHEN rtype = '{RESOURCE_TYPES[1]}' THEN 'jobservice.insert' END AS method_name,
         CASE WHEN rtype = '{RESOURCE_TYPES[1]}' THEN
              'projects/{PROJECT_ID}/locations/us/transferConfigs/cfg-' || CAST(k % 7 AS VARCHAR) || '/runs/r'
              || CAST(event_id AS VARCHAR) END AS resource_name
  FROM ev
)"""


_SEV_ERROR = "severity IN ('ERROR', 'CRITICAL', 'ALERT', 'EMERGENCY')"


def log_counts(metric: str, where: str, labels: dict[str, str], period: int = 300) -> str:
    lab = "".join(f"{expr} AS {name}, " for name, expr in sorted(labels.items()))
    names = "".join(f"{name}, " for name in sorted(labels))
    return f"""
WITH {log_entries_cte()},
m AS (
  SELECT {lab}time_bucket(INTERVAL '{period} seconds', ts) AS window_start
  FROM log_entries WHERE {_SEV_ERROR} AND {where}
)
SELECT '{metric}' AS metric, {names}window_start,
       window_start + INTERVAL '{period} seconds' AS window_end, COUNT(*) AS log_count
FROM m GROUP BY ALL"""


def log_metric_specs() -> dict[str, tuple[str, str, dict[str, str]]]:
    """Query name -> (metric, filter, label expressions) of the five log metrics."""
    from ledgerwatch.sources.fixtures import ENV_NAME
    env = f"resource_type = 'cloud_composer_environment' AND resource_labels['environment_name'] = '{ENV_NAME}'"
    task_failure = env + """ AND regexp_matches(text_payload, '"alert_type":\\s*"TASK_FAILURE"')"""
    return {
        "l1_task_errors": (
            "composer_task_errors", task_failure,
            {"dag_id": "json_extract_string(text_payload, '$.dag_id')",
             "task_id": "json_extract_string(text_payload, '$.task_id')",
             "alert_type": "json_extract_string(text_payload, '$.alert_type')"}),
        "l1_task_errors_regex_labels": (
            "composer_task_errors", task_failure,
            {"dag_id": "NULLIF(regexp_extract(text_payload, 'dag_id.{3,6}([a-zA-Z0-9_.-]+)', 1), '')",
             "task_id": "NULLIF(regexp_extract(text_payload, 'task_id.{3,6}([a-zA-Z0-9_.-]+)', 1), '')",
             "alert_type": "NULLIF(regexp_extract(text_payload, 'alert_type.{3,6}([A-Z_]+)', 1), '')"}),
        "l2_dag_parse_errors": (
            "composer_dag_parse_errors",
            env + " AND regexp_matches(text_payload, 'DagFileProcessorProcess|DagBag|import_errors')", {}),
        "l3_scheduled_query_failures": (
            "bq_scheduled_query_failures",
            "resource_type = 'bigquery_resource' AND regexp_matches(method_name, 'google.cloud.bigquery.datatransfer')",
            {"transfer_config_name": "NULLIF(regexp_extract(resource_name, 'transferConfigs/([^/]+)', 1), '')"}),
        "l4_stream_errors": (
            "datastream_stream_errors", "resource_type = 'datastream.googleapis.com/Stream'",
            {"stream_id": "resource_labels['stream_id']"}),
        "l5_backfill_errors": (
            "datastream_backfill_errors",
            "resource_type = 'datastream.googleapis.com/Stream' AND "
            "regexp_matches(text_payload, 'backfill|Backfill|BACKFILL')",
            {}),
    }


def log_queries() -> dict[str, str]:
    return {name: log_counts(metric, where, labels) for name, (metric, where, labels) in log_metric_specs().items()}


# --------------------------------------------------------------------------- series

def points_cte(health: bool = False) -> str:
    v = f"CASE WHEN value > {HEALTH_THRESHOLD} THEN 1.0 ELSE 0.0 END" if health else "value"
    return f"""points AS (
  SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS user_id, ts, CAST({v} AS DOUBLE) AS value
  FROM events
)"""


def align_sql(period: int, agg: str, health: bool = False, keys: str = "metric, user_id") -> str:
    return f"""
WITH {points_cte(health)}
SELECT {keys}, time_bucket(INTERVAL '{period} seconds', ts) AS window_start,
       time_bucket(INTERVAL '{period} seconds', ts) + INTERVAL '{period} seconds' AS window_end,
       CAST({agg} AS DOUBLE) AS value, COUNT(*) AS point_count
FROM points GROUP BY ALL"""


def aligned_cte(period: int, agg: str, health: bool = False) -> str:
    return f"""{points_cte(health)},
aligned AS (
  SELECT metric, user_id, time_bucket(INTERVAL '{period} seconds', ts) AS window_start,
         time_bucket(INTERVAL '{period} seconds', ts) + INTERVAL '{period} seconds' AS window_end,
         CAST({agg} AS DOUBLE) AS value
  FROM points GROUP BY ALL
)"""


REVENUE_TOP_WEIGHTED = f"""
SELECT product, region,
       CAST(SUM(order_count) AS BIGINT) AS total_orders,
       CAST(SUM(total_quantity) AS BIGINT) AS total_quantity,
       ROUND(SUM(total_revenue), 2) AS total_revenue,
       ROUND(SUM(total_revenue) / SUM(order_count), 2) AS avg_order_value
FROM ({REVENUE_MART}) m
GROUP BY product, region
ORDER BY total_revenue DESC, product, region
LIMIT 10"""

FRESHNESS = f"""
SELECT total_rows, minutes_since_last_ingest,
       COALESCE(minutes_since_last_ingest <= 60, FALSE) AS freshness_ok
FROM ({SILVER_QUALITY}) dq"""


def failure_records_sql() -> str:
    fields = ["alert_type", "source", "message", "dag_id", "task_id", "run_id", "execution_date", "log_url",
              "exception", "previous_state", "operator", "duration", "timestamp"]
    cols = ", ".join(f"json_extract_string(text_payload, '$.{f}') AS {f}" for f in fields)
    return f"""
WITH {log_entries_cte()}
SELECT ts, severity, {cols},
       CAST(json_extract(text_payload, '$.try_number') AS BIGINT) AS try_number,
       CAST(json_extract(text_payload, '$.max_tries') AS BIGINT) AS max_tries
FROM log_entries
WHERE starts_with(text_payload, '{{') AND json_extract_string(text_payload, '$.alert_type') IS NOT NULL"""
