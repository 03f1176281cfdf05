"""Fixture derivations: the pipeline's inputs built from the given test tables.

Each function reads the parquet tables under ``sf_dir`` and derives one input
of the pipeline with DataFrame operations only, so the work grows with the
tables.  The mapping is documented in FIXTURES.md; the DuckDB oracle SQL in
``ledgerwatch/plans/oracle_sql.py`` derives the same inputs with the same rules.

Join strategy for ``raw_orders``: lineitem and orders, the two large tables, are
sort-merge joined on the order key at every size, and that join comes last: its rows
lie by order key, which the aggregates on ``order_id`` behind it need no exchange for.
Customer joins the orders, part the lines before it (each by broadcast where its size
allows), so no shuffle carries the joined lines on; ``nation`` (25 rows) and
``region`` (5 rows) have a size fixed by the TPC-H schema and are broadcast
behind the plan-time size check of ``operators.joins.small_side``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch.operators.joins import small_side
from ledgerwatch.operators.upsert import (
    cast_projection,
    initial_load,
    latest_per_key_batches,
    merge_upsert,
    prepare_source,
    split_rejects,
)
from ledgerwatch.sources.contracts import BUSINESS_COLUMNS, METRIC_POINTS, MONEY, ORDER_KEY

# Fixed fixture parameters (deterministic stand-ins for CURRENT_TIMESTAMP()).
SEED_INGEST_TS = "2002-01-01 00:00:00"
INCOMING_INGEST_TS = "2002-01-01 00:15:00"
REPORT_AS_OF = "2002-01-01 01:00:00"
REPORT_DATE = "2002-01-01"
PROJECT_ID = "orders-lab"
UPDATED_AT_EPOCH = "1995-01-01"
# Lineage columns that break ties after updated_at (all descending).
TIE_BREAK = ["l_partkey", "l_suppkey", "l_linenumber", "total_price"]

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _status(returnflag: Column, linestatus: Column) -> Column:
    return (F.when(returnflag == "R", F.lit("cancelled"))
             .when(returnflag == "A", F.lit("delivered"))
             .when(linestatus == "O", F.lit("pending"))
             .when(linestatus == "F", F.lit("shipped")))


def raw_orders(spark: SparkSession, sf_dir: str, lineage: bool = True) -> DataFrame:
    """RAW ``public_orders``: one row per line item, lines act as versions."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")

    cust_region = (customer
                   .join(small_side(nation), customer.c_nationkey == nation.n_nationkey)
                   .join(small_side(region), F.col("n_regionkey") == region.r_regionkey)
                   .select("c_custkey", "r_name"))
    placed = orders.join(cust_region, F.col("o_custkey") == cust_region.c_custkey)
    lines = li.join(part, li.l_partkey == part.p_partkey)
    j = lines.join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    minutes = F.datediff(F.to_date("l_shipdate"), F.lit(UPDATED_AT_EPOCH).cast("date"))
    cols = [
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("p_name").alias("product"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        F.col("l_extendedprice").cast(MONEY).alias("total_price"),
        _status(F.col("l_returnflag"), F.col("l_linestatus")).alias("status"),
        F.col("r_name").alias("region"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
        F.timestamp_add("MINUTE", minutes, F.col("o_orderdate").cast("timestamp_ntz")).alias("updated_at"),
    ]
    if lineage:
        cols += [F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")]
    return j.select(*cols)


def split_raw(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Seed (odd line numbers) and incoming (even line numbers) halves.

    Together they hold every RAW row; the split gives every MERGE branch rows:
    keys only in the incoming half insert, keys only in the seed stay
    untouched, shared keys update or are ignored as stale.
    """
    odd = (F.col("l_linenumber") % 2) == 1
    return raw.filter(odd), raw.filter(~odd)


def silver_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    seed, _ = split_raw(raw_orders(spark, sf_dir))
    latest, _rej = prepare_source(seed, extra_order=TIE_BREAK)
    return initial_load(latest, SEED_INGEST_TS)


def latest_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Latest valid row per order of the seed half and of the incoming half.

    Same result as ``prepare_source`` on each half of :func:`split_raw`, but
    RAW is joined, cast and shuffled once: one aggregate on ``order_id`` keeps
    the latest row of both halves, and both outputs stay hash-partitioned on
    ``order_id`` for the MERGE join.
    """
    keep = [c for c in TIE_BREAK if c not in BUSINESS_COLUMNS]
    valid, _rej = split_rejects(cast_projection(raw_orders(spark, sf_dir), keep=keep))
    odd = (F.col("l_linenumber") % 2) == 1
    halves = latest_per_key_batches(valid, ORDER_KEY, ["updated_at"] + TIE_BREAK,
                                    {"seed": odd, "incoming": ~odd})
    return (halves["seed"].select(*BUSINESS_COLUMNS), halves["incoming"].select(*BUSINESS_COLUMNS))


def silver_merged(spark: SparkSession, sf_dir: str, with_action: bool = False) -> DataFrame:
    """SILVER after the seed load and one incoming CDC batch."""
    seed, incoming = latest_halves(spark, sf_dir)
    return merge_upsert(initial_load(seed, SEED_INGEST_TS), incoming, INCOMING_INGEST_TS,
                        with_action=with_action)


def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest, _ = prepare_source(raw_orders(spark, sf_dir), extra_order=TIE_BREAK)
    return latest.select(*BUSINESS_COLUMNS)


# --------------------------------------------------------------------------- jobs

def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job history from ``events``: one job per event, state by event type."""
    ev = read_table(spark, sf_dir, "events")
    processed = (F.col("value") * F.lit(1e9)).cast("bigint")
    ten_mb = F.lit(10 * 1024 * 1024)
    return ev.select(
        F.concat(F.lit("job_"), F.col("event_id").cast("string")).alias("job_id"),
        F.lit(PROJECT_ID).alias("project_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("user_email"),
        F.lit("QUERY").alias("job_type"),
        F.when(F.col("event_type") == "error", F.lit("RUNNING")).otherwise(F.lit("DONE")).alias("state"),
        F.col("ts").cast("timestamp_ntz").alias("creation_time"),
        F.timestamp_add("SECOND", F.col("value").cast("bigint"), F.col("ts").cast("timestamp_ntz")).alias("end_time"),
        (F.col("value") * F.lit(1e7)).cast("bigint").alias("total_slot_ms"),
        processed.alias("total_bytes_processed"),
        (F.ceil(processed / ten_mb) * ten_mb).cast("bigint").alias("total_bytes_billed"),
        F.concat(F.lit("SELECT "), F.col("props")).alias("query"),
    )


def table_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storage metadata from ``documents``: one table per document."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("source").alias("table_schema"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("table_name"),
        F.col("n_chars").cast("bigint").alias("total_logical_bytes"),
        ((F.col("n_chars") * (F.lit(1) + F.length("source") % 4)) / 4).cast("bigint").alias("total_physical_bytes"),
    )


# --------------------------------------------------------------------------- logs

# Fixed fixture vocabularies (resource types and DAG/task names of the pipeline).
RESOURCE_TYPES = ["cloud_composer_environment", "bigquery_resource", "datastream.googleapis.com/Stream"]
DAG_IDS = ["raw_to_silver", "silver_to_datamart", "notebook_executor", "chaos_monkey"]
TASK_IDS = ["merge_raw_to_silver", "revenue_by_product", "order_status_summary",
            "chaos_post_merge", "log_silver_row_count"]
ENV_NAME = "orders-composer"
TRANSFER_METHOD = "google.cloud.bigquery.datatransfer.v1.DataTransferService.StartManualTransferRuns"


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values)).cast("int") + 1)


def log_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log entries from ``events``.

    severity: ERROR for ``error`` events, WARNING for ``signup``, INFO otherwise.
    resource type by ``user_id`` (3 kinds); composer rows carry the failure
    listener's JSON body; props value ``k`` picks parse/backfill texts.
    """
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    rtype = _pick(RESOURCE_TYPES, F.col("user_id"))
    dag = _pick(DAG_IDS, F.col("event_id"))
    task = _pick(TASK_IDS, F.col("user_id"))
    ts_str = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss")
    failure_json = F.concat(
        F.lit('{"alert_type": "TASK_FAILURE", "source": "global_listener", "message": "Task '),
        task, F.lit(" in DAG "), dag, F.lit(' failed", "dag_id": "'), dag,
        F.lit('", "task_id": "'), task, F.lit('", "run_id": "scheduled__'), ts_str,
        F.lit('", "try_number": '), (F.col("event_id") % 3 + 1).cast("string"),
        F.lit(', "max_tries": 2, "execution_date": "'), ts_str,
        F.lit('", "log_url": "", "exception": "value '), F.col("value").cast("string"),
        F.lit('", "previous_state": "running", "operator": "PythonOperator", "duration": "'),
        F.col("value").cast("string"), F.lit('", "timestamp": "'), ts_str, F.lit('"}'))
    composer_text = (F.when(k < 20, F.concat(F.lit("DagBag import_errors while parsing dag "), dag))
                      .when(F.col("event_type") == "error", failure_json)
                      .otherwise(F.concat(F.lit("Task "), task, F.lit(" heartbeat"))))
    stream_text = (F.when(k < 30, F.concat(F.lit("Backfill failed for public.orders chunk "), k.cast("string")))
                    .otherwise(F.concat(F.lit("stream read batch "), k.cast("string"))))
    text = (F.when(rtype == RESOURCE_TYPES[0], composer_text)
             .when(rtype == RESOURCE_TYPES[2], stream_text)
             .otherwise(F.concat(F.lit("job "), F.col("event_id").cast("string"))))
    labels = (F.when(rtype == RESOURCE_TYPES[0], F.create_map(F.lit("environment_name"), F.lit(ENV_NAME)))
               .when(rtype == RESOURCE_TYPES[2], F.create_map(
                   F.lit("stream_id"), F.concat(F.lit("orders-stream-"), (F.col("user_id") % 4).cast("string"))))
               .otherwise(F.create_map(F.lit("project_id"), F.lit(PROJECT_ID))))
    is_bq = rtype == RESOURCE_TYPES[1]
    method = F.when(is_bq & (k < 50), F.lit(TRANSFER_METHOD)).when(is_bq, F.lit("jobservice.insert"))
    rname = F.when(is_bq, F.concat(F.lit("projects/" + PROJECT_ID + "/locations/us/transferConfigs/cfg-"),
                                   (k % 7).cast("string"), F.lit("/runs/r"), F.col("event_id").cast("string")))
    severity = (F.when(F.col("event_type") == "error", F.lit("ERROR"))
                 .when(F.col("event_type") == "signup", F.lit("WARNING"))
                 .otherwise(F.lit("INFO")))
    return ev.select(
        rtype.alias("resource_type"), labels.alias("resource_labels"), severity.alias("severity"),
        F.col("ts").cast("timestamp_ntz").alias("ts"), text.alias("text_payload"),
        method.alias("method_name"), rname.alias("resource_name"))


# --------------------------------------------------------------------------- metrics

HEALTH_THRESHOLD = 5.0  # boolean health = value above this constant


def metric_points(spark: SparkSession, sf_dir: str, health: bool = False) -> DataFrame:
    """Metric points from ``events``: metric = event_type, labels {user_id}.

    ``health=True`` turns the value into a 0/1 boolean (value above 5.0).
    """
    ev = read_table(spark, sf_dir, "events")
    value = (F.col("value") > F.lit(HEALTH_THRESHOLD)).cast("double") if health else F.col("value")
    return ev.select(
        F.col("event_type").alias("metric"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("labels"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        value.cast("double").alias("value"))


COUNTER_LIFE = 20


def counter_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative counters from ``events``: the running sum per type and user, which starts anew every ``COUNTER_LIFE`` points."""
    ev = read_table(spark, sf_dir, "events").select("event_type", F.col("user_id").cast("string").alias("user_id"), "event_id",
                                                    F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("value").cast("double").alias("value"))
    order = Window.partitionBy("event_type", "user_id").orderBy("ts", "event_id")
    lives = ev.withColumn("_life", F.floor(F.row_number().over(order) / COUNTER_LIFE))
    total = Window.partitionBy("event_type", "user_id", "_life").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return lives.select(F.col("event_type").alias("metric"), F.create_map(F.lit("user_id"), "user_id").alias("labels"), "ts",
                        F.sum("value").over(total).alias("value"))


# --------------------------------------------------------------------------- monitoring signals

STREAM_IDS = [f"orders-stream-{i}" for i in range(4)]
DATASETS = ["orders_raw", "orders_silver"]
#: Sources that nobody monitors: a second environment and a dataset off the list.
OTHER_ENV, OTHER_DATASET = "other-composer", "scratch"
BUCKETS = ["orders-landing", "orders-archive"]


def monitoring_points(spark: SparkSession, sf_dir: str, signals: set[str] | None = None) -> DataFrame:
    """Signals for the policies and panels, derived from ``events``,
    ``log_entries`` and ``job_log`` (one fixture binding per signal type).

    Each event feeds the signals of its type; labels and resource come from the
    event's user and id (one user in five works in ``OTHER_ENV``, one in three
    loads ``OTHER_DATASET``).  Log metrics come from the five log-metric filters.
    ``signals`` leaves out feeds of other metrics when the plan is built.
    """
    from ledgerwatch.operators import logs as _logs
    from ledgerwatch.plans import metrics as M

    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")
    value, user = F.col("value"), F.col("user_id")
    whole = F.floor("value").cast("double")
    empty = F.create_map().cast("map<string,string>")
    one = F.lit(1.0)
    flag = lambda c: c.cast("double")
    tag = lambda key, v: F.create_map(F.lit(key), v)
    dag = _pick(DAG_IDS, F.col("event_id"))
    stream = tag("stream_id", F.concat(F.lit("orders-stream-"), (user % 4).cast("string")))
    dataset = tag("dataset_id", _pick([*DATASETS, OTHER_DATASET], user))
    bucket = tag("bucket_name", _pick(BUCKETS, user))
    state = lambda bad, good, when: tag("state", F.when(when, F.lit(bad)).otherwise(F.lit(good)))
    env = tag("environment_name", F.when(user % 5 == 4, F.lit(OTHER_ENV)).otherwise(F.lit(ENV_NAME)))
    project = tag("project_id", F.lit(PROJECT_ID))
    run = lambda s: F.create_map(F.lit("state"), F.lit(s), F.lit("workflow_name"), dag)
    # (signal, event type, resource type, resource labels, labels, value): fixed fixture binding
    binding = [
        (M.COMPOSER_RUNS, "error", M.WORKFLOW, project, run("failed"), one),
        (M.COMPOSER_RUNS, "purchase", M.WORKFLOW, project, run("success"), one),
        (M.COMPOSER_TASKS, "click", M.ENVIRONMENT, env, state("failed", "success", value > 40), one),
        (M.HEARTBEAT, "view", M.ENVIRONMENT, env, empty, one),
        (M.EVICTIONS, "click", M.ENVIRONMENT, env, empty, flag(value > 45)),
        (M.DB_HEALTH, "signup", M.ENVIRONMENT, env, empty, flag(value > HEALTH_THRESHOLD)),
        (M.WEB_HEALTH, "click", M.ENVIRONMENT, env, empty, flag(value > 2.0)),
        (M.DAGBAG, "view", M.ENVIRONMENT, env, empty, whole),
        (M.UNFINISHED, "click", M.ENVIRONMENT, env, empty, whole),
        (M.ZOMBIES, "error", M.ENVIRONMENT, env, empty, flag(value > 40)),
        (M.PARSE_TIME, "signup", M.ENVIRONMENT, env, empty, value),
        (M.MEMORY_USED, "click", M.WORKLOAD, env, empty, whole * 1048576),
        (M.MEMORY_QUOTA, "view", M.WORKLOAD, env, empty, F.lit(134217728.0)),
        (M.STREAM_EVENTS, "purchase", M.STREAM, project, stream, one),
        (M.STREAM_LATENCY, "view", M.STREAM, project, stream, value * 60.0),
        (M.STREAM_FRESHNESS, "click", M.STREAM, project, stream, value),
        (M.STREAM_UNSUPPORTED, "error", M.STREAM, project, stream, one),
        (M.STREAM_BYTES, "purchase", M.STREAM, project, stream, whole * 1024),
        (M.SLOTS_AVAILABLE, "view", M.PROJECT, project, empty, whole + 100),
        (M.SLOTS_ALLOCATED, "purchase", M.PROJECT, project, empty, whole),
        (M.IN_FLIGHT, "click", M.PROJECT, project, state("pending", "running", value > 30), whole),
        (M.SCANNED_BYTES, "purchase", M.GLOBAL, project, empty, whole * 1048576),
        (M.BILLED_BYTES, "view", M.GLOBAL, project, empty, whole * 10485760),
        (M.UPLOADED_ROWS, "signup", M.DATASET, project, dataset, value),
        (M.UPLOADED_BYTES, "signup", M.DATASET, project, dataset, whole * 1024),
        (M.STORED_BYTES, "click", M.DATASET, project, dataset, whole * 1048576),
        (M.TABLE_COUNT, "purchase", M.DATASET, project, dataset, whole),
        (M.BUCKET_REQUESTS, "view", M.BUCKET, project, bucket, one),
        (M.BUCKET_EGRESS, "click", M.BUCKET, project, bucket, whole * 2048),
        (M.BUCKET_BYTES, "signup", M.BUCKET, project, bucket, whole * 1048576),
        (M.BUCKET_OBJECTS, "purchase", M.BUCKET, project, bucket, whole),
    ]
    wanted = lambda signal: signals is None or signal in signals
    feeds = []
    structs = [F.when(F.col("event_type") == e, F.struct(
        F.lit(sig).alias("metric"), F.lit(kind).alias("resource_type"), where.alias("resource_labels"), lab.alias("labels"),
        val.cast("double").alias("value"))) for sig, e, kind, where, lab, val in binding if wanted(sig)]
    if structs:
        feeds.append(ev.select("ts", F.explode(F.filter(F.array(*structs), lambda x: x.isNotNull())).alias("s")).select("s.*", "ts"))
    if any(map(wanted, (M.TASK_ERRORS, M.PARSE_ERRORS, M.STREAM_ERRORS, M.BACKFILL_ERRORS, M.SQ_FAILURES))):
        feeds.append(_logs.all_log_metric_points(log_entries(spark, sf_dir), ENV_NAME)
                     .withColumn("metric", F.concat(F.lit("logging.googleapis.com/user/"), F.col("metric"))))
    if wanted(M.QUERY_TIMES):
        feeds.append(job_log(spark, sf_dir).filter(F.col("state") == "DONE").select(
            F.lit(M.QUERY_TIMES).alias("metric"), F.lit(M.PROJECT).alias("resource_type"), project.alias("resource_labels"),
            empty.alias("labels"), F.col("creation_time").alias("ts"), (F.col("total_slot_ms") / 1000.0).alias("value")))
    if not feeds:
        return spark.createDataFrame([], METRIC_POINTS)
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed)
    return out
