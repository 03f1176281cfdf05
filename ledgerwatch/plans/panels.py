"""Dashboard panels re-aimed as panel queries (spec -> DataFrame).

Drawing is not built; each panel is its aligner/reducer/group-by spec and all
panels are evaluated in one pass with ``series.align_reduce_specs``.
Scorecards add the latest value and a colour (T12); the two MQL panels are
``align delta`` + ``group_by`` sums, one of them cut to its top 10 (T10).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch.operators import series
from ledgerwatch.operators.joins import local_table
from ledgerwatch.plans import metrics as M


@dataclass(frozen=True)
class Panel:
    panel_id: str
    signal: str
    resource: str | tuple             # type, or (type, environment)
    aligner: str
    period_s: int = 300
    reducer: str = "NONE"
    group_by: tuple = ()
    label_filter: tuple = ()          # ((key, value), ...)
    scorecard: tuple | None = None    # (direction, yellow, red)
    top_n: int | None = None


def dashboard_panels(environment_name: str) -> list[Panel]:
    """The 34 panels of the three dashboards in their order; the memory and slot
    charts plot two metrics each, so there are 36 specs (fixed values: signal,
    resource, aligner, period, reducer, group-by, scorecard thresholds).  A
    resource is a type, or a type with the environment it is read from."""
    own, workload = (M.ENVIRONMENT, environment_name), (M.WORKLOAD, environment_name)
    return [
        Panel("composer_db_health", M.DB_HEALTH, own, "ALIGN_FRACTION_TRUE", scorecard=("BELOW", None, 0.9)),
        Panel("composer_heartbeat", M.HEARTBEAT, own, "ALIGN_SUM", scorecard=("BELOW", None, 1)),
        Panel("composer_dagbag", M.DAGBAG, own, "ALIGN_MEAN", scorecard=("ABOVE", None, None)),
        Panel("composer_unfinished", M.UNFINISHED, own, "ALIGN_MAX", scorecard=("ABOVE", 50, None)),
        Panel("composer_zombies", M.ZOMBIES, own, "ALIGN_SUM", scorecard=("ABOVE", 1, None)),
        Panel("composer_runs_by_state", M.COMPOSER_RUNS, M.WORKFLOW, "ALIGN_SUM", reducer="REDUCE_SUM", group_by=("state",)),
        Panel("composer_tasks_by_state", M.COMPOSER_TASKS, own, "ALIGN_SUM", reducer="REDUCE_SUM", group_by=("state",)),
        Panel("composer_task_errors", M.TASK_ERRORS, M.ENVIRONMENT, "ALIGN_SUM", reducer="REDUCE_SUM", group_by=("dag_id", "task_id")),
        Panel("composer_evictions", M.EVICTIONS, own, "ALIGN_SUM", period_s=900),
        Panel("composer_memory_used", M.MEMORY_USED, workload, "ALIGN_MEAN", reducer="REDUCE_SUM"),
        Panel("composer_memory_limit", M.MEMORY_QUOTA, workload, "ALIGN_MEAN", reducer="REDUCE_SUM"),
        Panel("composer_parse_time", M.PARSE_TIME, own, "ALIGN_MEAN"),
        Panel("composer_parse_errors", M.PARSE_ERRORS, M.ENVIRONMENT, "ALIGN_SUM"),
        Panel("stream_event_rate", M.STREAM_EVENTS, M.STREAM, "ALIGN_RATE", reducer="REDUCE_SUM", group_by=("stream_id",)),
        Panel("stream_lag", M.STREAM_FRESHNESS, M.STREAM, "ALIGN_MAX", reducer="REDUCE_MAX", group_by=("stream_id",)),
        Panel("stream_unsupported", M.STREAM_UNSUPPORTED, M.STREAM, "ALIGN_SUM", reducer="REDUCE_SUM", group_by=("stream_id",)),
        Panel("stream_bytes_rate", M.STREAM_BYTES, M.STREAM, "ALIGN_RATE", reducer="REDUCE_SUM", group_by=("stream_id",)),
        Panel("bq_slots_available", M.SLOTS_AVAILABLE, M.PROJECT, "ALIGN_MEAN"),
        Panel("bq_slots_allocated", M.SLOTS_ALLOCATED, M.PROJECT, "ALIGN_MEAN"),
        Panel("bq_jobs_in_flight", M.IN_FLIGHT, M.PROJECT, "ALIGN_MEAN", reducer="REDUCE_SUM", group_by=("state",)),
        Panel("bq_scanned_bytes", M.SCANNED_BYTES, M.GLOBAL, "ALIGN_SUM"),
        Panel("bq_query_errors", M.SQ_FAILURES, M.GLOBAL, "ALIGN_SUM"),
        Panel("summary_scheduler", M.HEARTBEAT, own, "ALIGN_SUM", scorecard=("BELOW", None, 1)),
        Panel("summary_webserver", M.WEB_HEALTH, own, "ALIGN_FRACTION_TRUE", scorecard=("BELOW", None, 0.9)),
        Panel("summary_database", M.DB_HEALTH, own, "ALIGN_FRACTION_TRUE", scorecard=("BELOW", None, 0.9)),
        Panel("summary_failed_runs_total", M.COMPOSER_RUNS, M.WORKFLOW, "ALIGN_DELTA", period_s=3600, reducer="REDUCE_SUM",
              label_filter=(("state", "failed"),), scorecard=("ABOVE", None, 1)),
        Panel("summary_failed_runs_top", M.COMPOSER_RUNS, M.WORKFLOW, "ALIGN_DELTA", period_s=300, reducer="REDUCE_SUM",
              group_by=("workflow_name",), label_filter=(("state", "failed"),), top_n=10),
        Panel("bq_uploaded_bytes", M.UPLOADED_BYTES, M.DATASET, "ALIGN_SUM", reducer="REDUCE_SUM", group_by=("dataset_id",)),
        Panel("bq_uploaded_rows", M.UPLOADED_ROWS, M.DATASET, "ALIGN_SUM", reducer="REDUCE_SUM", group_by=("dataset_id",)),
        Panel("bq_stored_bytes", M.STORED_BYTES, M.DATASET, "ALIGN_MEAN", period_s=86400, reducer="REDUCE_SUM", group_by=("dataset_id",)),
        Panel("bq_table_count", M.TABLE_COUNT, M.DATASET, "ALIGN_MEAN", period_s=86400, reducer="REDUCE_SUM", group_by=("dataset_id",)),
        Panel("bq_bytes_billed", M.BILLED_BYTES, M.GLOBAL, "ALIGN_SUM"),
        Panel("gcs_requests", M.BUCKET_REQUESTS, M.BUCKET, "ALIGN_SUM", reducer="REDUCE_SUM", group_by=("bucket_name",)),
        Panel("gcs_egress", M.BUCKET_EGRESS, M.BUCKET, "ALIGN_SUM", reducer="REDUCE_SUM", group_by=("bucket_name",)),
        Panel("gcs_bucket_size", M.BUCKET_BYTES, M.BUCKET, "ALIGN_MEAN", period_s=86400, reducer="REDUCE_SUM", group_by=("bucket_name",)),
        Panel("gcs_object_count", M.BUCKET_OBJECTS, M.BUCKET, "ALIGN_MEAN", period_s=86400, reducer="REDUCE_SUM", group_by=("bucket_name",)),
    ]


def panel_table(spark: SparkSession, panels: list[Panel]) -> DataFrame:
    for p in panels:
        series.check_spec(p.panel_id, p.aligner, p.reducer)
    scope = {p.panel_id: p.resource if isinstance(p.resource, tuple) else (p.resource, None) for p in panels}
    rows = [(p.panel_id, p.signal, scope[p.panel_id][0], {"environment_name": env} if (env := scope[p.panel_id][1]) else {},
             dict(p.label_filter), p.aligner, int(p.period_s), p.reducer, list(p.group_by))
            for p in panels]
    return local_table(spark, rows, series.SPEC_SCHEMA)


def evaluate_panels(points: DataFrame, panels: list[Panel], exact: bool = True) -> DataFrame:
    """All panel series in one pass: ``spec_id, series_key, labels, window_start,
    window_end, value, series_count`` (``spec_id`` = panel id)."""
    return series.align_reduce_specs(points, panel_table(points.sparkSession, panels), exact,
                                     any(p.aligner.startswith("ALIGN_PERCENTILE_") for p in panels), frozenset(p.aligner for p in panels))


def scorecards(panel_series: DataFrame, panels: list[Panel]) -> DataFrame:
    """T12 for every scorecard panel: latest value per series and its colour."""
    cards = [p for p in panels if p.scorecard]
    latest = (panel_series.filter(F.col("spec_id").isin([p.panel_id for p in cards]))
              .groupBy("spec_id", "series_key")
              .agg(F.max_by("value", "window_start").alias("value"), F.max("window_start").alias("window_start")))
    colour = F.lit("green")
    for p in cards:
        direction, yellow, red = p.scorecard

        def breach(th, d=direction):
            if th is None:
                return F.lit(False)
            return (F.col("value") < F.lit(float(th))) if d == "BELOW" else (F.col("value") > F.lit(float(th)))
        colour = F.when((F.col("spec_id") == p.panel_id) & breach(red), F.lit("red")) \
                  .when((F.col("spec_id") == p.panel_id) & breach(yellow), F.lit("yellow")).otherwise(colour)
    return latest.select("spec_id", F.map_from_entries("series_key").alias("labels"), "window_start", "value",
                         colour.alias("colour"))


def top_panels(panel_series: DataFrame, panels: list[Panel]) -> DataFrame:
    """T10 for every ``top_n`` panel: the top series by total, ties by key.

    Each top panel gets its own rank filter with a literal limit, so Spark
    plans a WindowGroupLimit that keeps a partial top-n per task before the
    shuffle; a panel with millions of series never sorts them all in one task.
    The totals aggregate is shared by the panels (one exchange, reused).
    """
    tops = [p for p in panels if p.top_n]
    totals = (panel_series.filter(F.col("spec_id").isin([p.panel_id for p in tops]))
              .groupBy("spec_id", "series_key").agg(F.sum("value").alias("total")))
    w = Window.partitionBy("spec_id").orderBy(F.col("total").desc(), "series_key")
    out = None
    for p in tops:
        ranked = (totals.filter(F.col("spec_id") == p.panel_id)
                  .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= p.top_n))
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = totals.withColumn("rank", F.lit(0)).filter(F.lit(False))
    return out.select("spec_id", F.map_from_entries("series_key").alias("labels"), "total", "rank")
