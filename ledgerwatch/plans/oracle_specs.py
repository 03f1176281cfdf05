"""The policies and panels a second time, for the DuckDB oracles (fixed values).

Nothing here is taken from ``policies.py``, ``panels.py`` or ``metrics.py``, so a
wrong threshold, metric, resource or period on either side fails a query.
"""

from __future__ import annotations

from typing import NamedTuple

ENV = "orders-composer"
STREAMS = ("orders-stream-0", "orders-stream-1", "orders-stream-2", "orders-stream-3")
MONITORED = ("orders_raw", "orders_silver")


class PolicySpec(NamedTuple):
    policy_id: str
    name: str
    condition: str
    severity: str
    auto_close_s: int
    signal: str
    resource: str
    own_env: bool
    state: str | None
    aligner: str
    period_s: int
    reducer: str
    group_by: tuple
    kind: str
    comparison: str
    threshold: float
    duration_s: int
    among: tuple | None          # (label, values): the series that are watched, and must report if absent
    message: tuple               # text, label, text, label, ...


_C, _D, _B = "cloud_composer_environment", "datastream.googleapis.com/Stream", "bigquery_project"
_GT, _LT = "COMPARISON_GT", "COMPARISON_LT"

POLICY_SPECS = [
    PolicySpec("composer_failed_runs", "Composer - Failed DAG Runs", "DAG run count with state=failed > 0", "CRITICAL", 1800,
               "composer.googleapis.com/workflow/run_count", "cloud_composer_workflow", False, "failed",
               "ALIGN_SUM", 300, "NONE", (), "threshold", _GT, 0, 0, None,
               ("A DAG run has failed in Cloud Composer environment 'orders-composer'.",)),
    PolicySpec("composer_failed_tasks", "Composer - Failed Task Instances", "Finished task instance count with state=failed > 0", "CRITICAL", 1800,
               "composer.googleapis.com/environment/finished_task_instance_count", _C, True, "failed",
               "ALIGN_SUM", 300, "NONE", (), "threshold", _GT, 0, 0, None,
               ("Task instances have failed in environment 'orders-composer'.",)),
    PolicySpec("composer_heartbeat", "Composer - Scheduler Heartbeat Missing", "Scheduler heartbeat absent for 5 minutes", "CRITICAL", 3600,
               "composer.googleapis.com/environment/scheduler_heartbeat_count", _C, True, None,
               "ALIGN_SUM", 300, "NONE", (), "absent", _GT, 0, 300, None,
               ("The scheduler has stopped sending heartbeats.",)),
    PolicySpec("composer_evictions", "Composer - Worker Pod Evictions", "Worker pod eviction count > 0", "WARNING", 3600,
               "composer.googleapis.com/environment/worker/pod_eviction_count", _C, True, None,
               "ALIGN_SUM", 900, "NONE", (), "threshold", _GT, 0, 0, None,
               ("Worker pods are being evicted.",)),
    PolicySpec("composer_db_health", "Composer - Database Health Degraded", "Database health is unhealthy", "WARNING", 3600,
               "composer.googleapis.com/environment/database_health", _C, True, None,
               "ALIGN_FRACTION_TRUE", 300, "NONE", (), "threshold", _LT, 1, 300, None,
               ("The metadata database is unhealthy.",)),
    PolicySpec("composer_error_logs", "Composer - Error Logs Detected", "Error log count > 0", "CRITICAL", 1800,
               "logging.googleapis.com/user/composer_task_errors", _C, False, None,
               "ALIGN_SUM", 300, "REDUCE_SUM", ("dag_id", "task_id", "alert_type"), "threshold", _GT, 0, 0, None,
               ("Error logs in environment 'orders-composer': DAG ", "dag_id", ", task ", "task_id", ", type ", "alert_type", ".")),
    PolicySpec("composer_parse_errors", "Composer - DAG Parse Errors", "DAG parse error count > 0", "ERROR", 1800,
               "logging.googleapis.com/user/composer_dag_parse_errors", _C, False, None,
               "ALIGN_SUM", 300, "NONE", (), "threshold", _GT, 0, 0, None,
               ("DAG parsing errors have been detected.",)),
    PolicySpec("composer_web_health", "Composer - Webserver Health Degraded", "Webserver health is unhealthy", "CRITICAL", 3600,
               "composer.googleapis.com/environment/web_server/health", _C, True, None,
               "ALIGN_FRACTION_TRUE", 300, "NONE", (), "threshold", _LT, 1, 300, None,
               ("The webserver is unhealthy.",)),
    PolicySpec("stream_stale", "Datastream - Stream Throughput Stale", "Datastream event count absent for 15 minutes", "CRITICAL", 3600,
               "datastream.googleapis.com/stream/event_count", _D, False, None,
               "ALIGN_SUM", 300, "NONE", (), "absent", _GT, 0, 900, ("stream_id", STREAMS),
               ("No events received from stream ", "stream_id", " for 15 minutes.")),
    PolicySpec("stream_unhealthy", "Datastream - Stream Unhealthy", "Datastream error log count > 0", "CRITICAL", 3600,
               "logging.googleapis.com/user/datastream_stream_errors", _D, False, None,
               "ALIGN_SUM", 300, "NONE", (), "threshold", _GT, 0, 0, None,
               ("Stream ", "stream_id", " reports errors.")),
    PolicySpec("stream_backfill", "Datastream - Backfill Failures", "Backfill error count > 0", "WARNING", 3600,
               "logging.googleapis.com/user/datastream_backfill_errors", _D, False, None,
               "ALIGN_SUM", 300, "NONE", (), "threshold", _GT, 0, 0, None,
               ("Backfill errors detected.",)),
    PolicySpec("stream_lag", "Datastream - High Replication Lag", "Replication lag > 1800s", "WARNING", 3600,
               "datastream.googleapis.com/stream/total_latencies", _D, False, None,
               "ALIGN_PERCENTILE_99", 300, "NONE", (), "threshold", _GT, 1800, 300, None,
               ("Replication lag above threshold on ", "stream_id", ".")),
    PolicySpec("bq_slot_time", "BigQuery - High Slot-Time Jobs", "Job slot-seconds > 86400", "WARNING", 3600,
               "bigquery.googleapis.com/query/execution_times", _B, False, None,
               "ALIGN_PERCENTILE_99", 300, "NONE", (), "threshold", _GT, 86400, 0, None,
               ("A job exceeded the slot-time threshold.",)),
    PolicySpec("bq_scheduled_failures", "BigQuery - Scheduled Query Failures", "Scheduled query failure count > 0", "CRITICAL", 1800,
               "logging.googleapis.com/user/bq_scheduled_query_failures", "global", False, None,
               "ALIGN_SUM", 300, "NONE", (), "threshold", _GT, 0, 0, None,
               ("Scheduled query ", "transfer_config_name", " failed.")),
    PolicySpec("bq_freshness", "BigQuery - Data Freshness Stale", "Table last modified time absent for 3600s", "WARNING", 3600,
               "bigquery.googleapis.com/storage/uploaded_row_count", "bigquery_dataset", False, None,
               "ALIGN_SUM", 300, "NONE", (), "absent", _GT, 0, 3600, ("dataset_id", MONITORED),
               ("Dataset ", "dataset_id", " has had no uploads.")),
]

#: panel, metric type, resource type, own environment only, aligner, period, reducer, group by, state
PANEL_SPECS = [
    ("composer_db_health", "composer.googleapis.com/environment/database_health", _C, True, "ALIGN_FRACTION_TRUE", 300, "NONE", (), None),
    ("composer_heartbeat", "composer.googleapis.com/environment/scheduler_heartbeat_count", _C, True, "ALIGN_SUM", 300, "NONE", (), None),
    ("composer_dagbag", "composer.googleapis.com/environment/dagbag_size", _C, True, "ALIGN_MEAN", 300, "NONE", (), None),
    ("composer_unfinished", "composer.googleapis.com/environment/unfinished_task_instances", _C, True, "ALIGN_MAX", 300, "NONE", (), None),
    ("composer_zombies", "composer.googleapis.com/environment/scheduler/zombies_killed", _C, True, "ALIGN_SUM", 300, "NONE", (), None),
    ("composer_runs_by_state", "composer.googleapis.com/workflow/run_count", "cloud_composer_workflow", False, "ALIGN_SUM", 300, "REDUCE_SUM", ("state",), None),
    ("composer_tasks_by_state", "composer.googleapis.com/environment/finished_task_instance_count", _C, True, "ALIGN_SUM", 300, "REDUCE_SUM", ("state",), None),
    ("composer_task_errors", "logging.googleapis.com/user/composer_task_errors", _C, False, "ALIGN_SUM", 300, "REDUCE_SUM", ("dag_id", "task_id"), None),
    ("composer_evictions", "composer.googleapis.com/environment/worker/pod_eviction_count", _C, True, "ALIGN_SUM", 900, "NONE", (), None),
    ("composer_memory_used", "composer.googleapis.com/workload/memory/bytes_used", "cloud_composer_workload", True, "ALIGN_MEAN", 300, "REDUCE_SUM", (), None),
    ("composer_memory_limit", "composer.googleapis.com/workload/memory/quota", "cloud_composer_workload", True, "ALIGN_MEAN", 300, "REDUCE_SUM", (), None),
    ("composer_parse_time", "composer.googleapis.com/environment/dag_processing/total_parse_time", _C, True, "ALIGN_MEAN", 300, "NONE", (), None),
    ("composer_parse_errors", "logging.googleapis.com/user/composer_dag_parse_errors", _C, False, "ALIGN_SUM", 300, "NONE", (), None),
    ("stream_event_rate", "datastream.googleapis.com/stream/event_count", _D, False, "ALIGN_RATE", 300, "REDUCE_SUM", ("stream_id",), None),
    ("stream_lag", "datastream.googleapis.com/stream/freshness", _D, False, "ALIGN_MAX", 300, "REDUCE_MAX", ("stream_id",), None),
    ("stream_unsupported", "datastream.googleapis.com/stream/unsupported_event_count", _D, False, "ALIGN_SUM", 300, "REDUCE_SUM", ("stream_id",), None),
    ("stream_bytes_rate", "datastream.googleapis.com/stream/bytes_count", _D, False, "ALIGN_RATE", 300, "REDUCE_SUM", ("stream_id",), None),
    ("bq_slots_available", "bigquery.googleapis.com/slots/total_available", _B, False, "ALIGN_MEAN", 300, "NONE", (), None),
    ("bq_slots_allocated", "bigquery.googleapis.com/slots/allocated_for_project", _B, False, "ALIGN_MEAN", 300, "NONE", (), None),
    ("bq_jobs_in_flight", "bigquery.googleapis.com/job/num_in_flight", _B, False, "ALIGN_MEAN", 300, "REDUCE_SUM", ("state",), None),
    ("bq_scanned_bytes", "bigquery.googleapis.com/query/scanned_bytes", "global", False, "ALIGN_SUM", 300, "NONE", (), None),
    ("bq_query_errors", "logging.googleapis.com/user/bq_scheduled_query_failures", "global", False, "ALIGN_SUM", 300, "NONE", (), None),
    ("summary_scheduler", "composer.googleapis.com/environment/scheduler_heartbeat_count", _C, True, "ALIGN_SUM", 300, "NONE", (), None),
    ("summary_webserver", "composer.googleapis.com/environment/web_server/health", _C, True, "ALIGN_FRACTION_TRUE", 300, "NONE", (), None),
    ("summary_database", "composer.googleapis.com/environment/database_health", _C, True, "ALIGN_FRACTION_TRUE", 300, "NONE", (), None),
    ("summary_failed_runs_total", "composer.googleapis.com/workflow/run_count", "cloud_composer_workflow", False, "ALIGN_DELTA", 3600, "REDUCE_SUM", (), "failed"),
    ("summary_failed_runs_top", "composer.googleapis.com/workflow/run_count", "cloud_composer_workflow", False, "ALIGN_DELTA", 300, "REDUCE_SUM", ("workflow_name",), "failed"),
    ("bq_uploaded_bytes", "bigquery.googleapis.com/storage/uploaded_bytes", "bigquery_dataset", False, "ALIGN_SUM", 300, "REDUCE_SUM", ("dataset_id",), None),
    ("bq_uploaded_rows", "bigquery.googleapis.com/storage/uploaded_row_count", "bigquery_dataset", False, "ALIGN_SUM", 300, "REDUCE_SUM", ("dataset_id",), None),
    ("bq_stored_bytes", "bigquery.googleapis.com/storage/stored_bytes", "bigquery_dataset", False, "ALIGN_MEAN", 86400, "REDUCE_SUM", ("dataset_id",), None),
    ("bq_table_count", "bigquery.googleapis.com/storage/table_count", "bigquery_dataset", False, "ALIGN_MEAN", 86400, "REDUCE_SUM", ("dataset_id",), None),
    ("bq_bytes_billed", "bigquery.googleapis.com/query/scanned_bytes_billed", "global", False, "ALIGN_SUM", 300, "NONE", (), None),
    ("gcs_requests", "storage.googleapis.com/api/request_count", "gcs_bucket", False, "ALIGN_SUM", 300, "REDUCE_SUM", ("bucket_name",), None),
    ("gcs_egress", "storage.googleapis.com/network/sent_bytes_count", "gcs_bucket", False, "ALIGN_SUM", 300, "REDUCE_SUM", ("bucket_name",), None),
    ("gcs_bucket_size", "storage.googleapis.com/storage/total_bytes", "gcs_bucket", False, "ALIGN_MEAN", 86400, "REDUCE_SUM", ("bucket_name",), None),
    ("gcs_object_count", "storage.googleapis.com/storage/object_count", "gcs_bucket", False, "ALIGN_MEAN", 86400, "REDUCE_SUM", ("bucket_name",), None),
]

#: scorecard -> conditions of its colours
SCORECARDS = {
    "composer_db_health": {"red": "value < 0.9"}, "composer_heartbeat": {"red": "value < 1"}, "composer_dagbag": {},
    "composer_unfinished": {"yellow": "value > 50"}, "composer_zombies": {"yellow": "value > 1"},
    "summary_scheduler": {"red": "value < 1"}, "summary_webserver": {"red": "value < 0.9"}, "summary_database": {"red": "value < 0.9"},
    "summary_failed_runs_total": {"red": "value > 1"},
}
TOP_PANELS = {"summary_failed_runs_top": 10}
