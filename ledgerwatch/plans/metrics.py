"""Names of the monitored metrics and resource types (fixed values of the monitoring layer)."""

# Metric types of the orchestrator's environment, workflows and workloads.
COMPOSER_RUNS = "composer.googleapis.com/workflow/run_count"
COMPOSER_TASKS = "composer.googleapis.com/environment/finished_task_instance_count"
HEARTBEAT = "composer.googleapis.com/environment/scheduler_heartbeat_count"
EVICTIONS = "composer.googleapis.com/environment/worker/pod_eviction_count"
DB_HEALTH = "composer.googleapis.com/environment/database_health"
WEB_HEALTH = "composer.googleapis.com/environment/web_server/health"
DAGBAG = "composer.googleapis.com/environment/dagbag_size"
UNFINISHED = "composer.googleapis.com/environment/unfinished_task_instances"
ZOMBIES = "composer.googleapis.com/environment/scheduler/zombies_killed"
PARSE_TIME = "composer.googleapis.com/environment/dag_processing/total_parse_time"
MEMORY_USED = "composer.googleapis.com/workload/memory/bytes_used"
MEMORY_QUOTA = "composer.googleapis.com/workload/memory/quota"

# Log-based metrics.
TASK_ERRORS = "logging.googleapis.com/user/composer_task_errors"
PARSE_ERRORS = "logging.googleapis.com/user/composer_dag_parse_errors"
STREAM_ERRORS = "logging.googleapis.com/user/datastream_stream_errors"
BACKFILL_ERRORS = "logging.googleapis.com/user/datastream_backfill_errors"
SQ_FAILURES = "logging.googleapis.com/user/bq_scheduled_query_failures"

# Change streams.
STREAM_EVENTS = "datastream.googleapis.com/stream/event_count"
STREAM_LATENCY = "datastream.googleapis.com/stream/total_latencies"
STREAM_FRESHNESS = "datastream.googleapis.com/stream/freshness"
STREAM_UNSUPPORTED = "datastream.googleapis.com/stream/unsupported_event_count"
STREAM_BYTES = "datastream.googleapis.com/stream/bytes_count"

# Warehouse.
QUERY_TIMES = "bigquery.googleapis.com/query/execution_times"
SLOTS_AVAILABLE = "bigquery.googleapis.com/slots/total_available"
SLOTS_ALLOCATED = "bigquery.googleapis.com/slots/allocated_for_project"
IN_FLIGHT = "bigquery.googleapis.com/job/num_in_flight"
SCANNED_BYTES = "bigquery.googleapis.com/query/scanned_bytes"
BILLED_BYTES = "bigquery.googleapis.com/query/scanned_bytes_billed"
UPLOADED_BYTES = "bigquery.googleapis.com/storage/uploaded_bytes"
UPLOADED_ROWS = "bigquery.googleapis.com/storage/uploaded_row_count"
STORED_BYTES = "bigquery.googleapis.com/storage/stored_bytes"
TABLE_COUNT = "bigquery.googleapis.com/storage/table_count"

# Buckets.
BUCKET_REQUESTS = "storage.googleapis.com/api/request_count"
BUCKET_EGRESS = "storage.googleapis.com/network/sent_bytes_count"
BUCKET_BYTES = "storage.googleapis.com/storage/total_bytes"
BUCKET_OBJECTS = "storage.googleapis.com/storage/object_count"

# Resource types.
ENVIRONMENT = "cloud_composer_environment"
WORKFLOW = "cloud_composer_workflow"
WORKLOAD = "cloud_composer_workload"
STREAM = "datastream.googleapis.com/Stream"
PROJECT = "bigquery_project"
DATASET = "bigquery_dataset"
GLOBAL = "global"
BUCKET = "gcs_bucket"
