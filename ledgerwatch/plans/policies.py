"""Alert policies as configuration, evaluated in one pass.

The 15 policies of the monitoring layer are rows of a small config table.
:func:`evaluate_policies` joins the metric points with that (broadcast) table
once, aligns and reduces every policy's series in one aggregate
(``series.align_reduce_specs``), turns threshold policies into hold episodes
and absence policies into gap episodes, merges episodes into incidents with the
policy's auto-close, and renders the notification payload.  Nothing is run per
policy.  The aligned series, small beside the points, are written to the shared
folder once; episodes, gaps and incidents are evaluated on them.

E6: policies that the reference only creates when a list is non-empty (stream
ids, monitored datasets) are filtered at plan time in :func:`monitoring_policies`.
Q7/Q8: the slot-time threshold is a parameter; the freshness policy filters
on the monitored datasets.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions.scalar import render_template
from ledgerwatch.operators import alerts, series
from ledgerwatch.operators.joins import local_table, small_side
from ledgerwatch.plans import metrics as M
from ledgerwatch.session import scratch_path


@dataclass(frozen=True)
class Policy:
    policy_id: str
    name: str
    signal: str
    kind: str                       # "threshold" | "absent"
    aligner: str = "ALIGN_SUM"
    period_s: int = 300
    reducer: str = "NONE"
    group_by: tuple = ()
    comparison: str = "COMPARISON_GT"
    threshold: float = 0.0
    duration_s: int = 0
    severity: str = "CRITICAL"
    auto_close_s: int = 1800
    label_filter: dict = field(default_factory=dict)
    documentation: str = ""
    condition: str = ""             # display name of the condition
    enabled: bool = True
    expected: tuple = ()            # absence: series that must report, as label dicts
    label_any: dict = field(default_factory=dict)   # label -> values, one of which a series must carry
    resource_type: str | None = None                # None: any resource
    resource_labels: dict = field(default_factory=dict)


def monitoring_policies(environment_name: str, stream_ids: list[str] = (), monitored_datasets: list[str] = (),
                        lag_threshold_s: float = 1800, slot_time_threshold: float = 86400,
                        freshness_absent_s: int = 3600) -> list[Policy]:
    """The 15 policies (fixed values: signals, aligners, periods, conditions,
    severities and auto-close of the reference's monitoring specs)."""
    failed = {"state": "failed"}
    own = {"resource_type": M.ENVIRONMENT, "resource_labels": {"environment_name": environment_name}}
    out = [
        Policy("composer_failed_runs", "Composer - Failed DAG Runs", M.COMPOSER_RUNS, "threshold",
               condition="DAG run count with state=failed > 0", resource_type=M.WORKFLOW, label_filter=failed, severity="CRITICAL", auto_close_s=1800,
               documentation="A DAG run has failed in Cloud Composer environment '" + environment_name + "'."),
        Policy("composer_failed_tasks", "Composer - Failed Task Instances", M.COMPOSER_TASKS, "threshold",
               condition="Finished task instance count with state=failed > 0", **own, label_filter=failed, severity="CRITICAL", auto_close_s=1800,
               documentation="Task instances have failed in environment '" + environment_name + "'."),
        Policy("composer_heartbeat", "Composer - Scheduler Heartbeat Missing", M.HEARTBEAT, "absent",
               condition="Scheduler heartbeat absent for 5 minutes", **own, duration_s=300, severity="CRITICAL", auto_close_s=3600, expected=({},),
               documentation="The scheduler has stopped sending heartbeats."),
        Policy("composer_evictions", "Composer - Worker Pod Evictions", M.EVICTIONS, "threshold",
               condition="Worker pod eviction count > 0", **own, period_s=900, severity="WARNING", auto_close_s=3600,
               documentation="Worker pods are being evicted."),
        Policy("composer_db_health", "Composer - Database Health Degraded", M.DB_HEALTH, "threshold",
               condition="Database health is unhealthy", **own, aligner="ALIGN_FRACTION_TRUE", comparison="COMPARISON_LT", threshold=1, duration_s=300,
               severity="WARNING", auto_close_s=3600, documentation="The metadata database is unhealthy."),
        Policy("composer_error_logs", "Composer - Error Logs Detected", M.TASK_ERRORS, "threshold",
               condition="Error log count > 0", resource_type=M.ENVIRONMENT, reducer="REDUCE_SUM", group_by=("dag_id", "task_id", "alert_type"), severity="CRITICAL",
               auto_close_s=1800,
               documentation="Error logs in environment '" + environment_name + "': DAG ${metric.labels.dag_id}, task ${metric.labels.task_id}, "
                             "type ${metric.labels.alert_type}."),
        Policy("composer_parse_errors", "Composer - DAG Parse Errors", M.PARSE_ERRORS, "threshold",
               condition="DAG parse error count > 0", resource_type=M.ENVIRONMENT, severity="ERROR", auto_close_s=1800, documentation="DAG parsing errors have been detected."),
        Policy("composer_web_health", "Composer - Webserver Health Degraded", M.WEB_HEALTH, "threshold",
               condition="Webserver health is unhealthy", **own, aligner="ALIGN_FRACTION_TRUE", comparison="COMPARISON_LT", threshold=1, duration_s=300,
               severity="CRITICAL", auto_close_s=3600, documentation="The webserver is unhealthy."),
    ]
    if stream_ids:   # E6: created only when stream ids are configured
        out += [
            Policy("stream_stale", "Datastream - Stream Throughput Stale", M.STREAM_EVENTS, "absent",
                   condition="Datastream event count absent for 15 minutes", resource_type=M.STREAM, duration_s=900, severity="CRITICAL", auto_close_s=3600,
                   expected=tuple({"stream_id": s} for s in stream_ids), label_any={"stream_id": tuple(stream_ids)},
                   documentation="No events received from stream ${metric.labels.stream_id} for 15 minutes."),
            Policy("stream_unhealthy", "Datastream - Stream Unhealthy", M.STREAM_ERRORS, "threshold",
                   condition="Datastream error log count > 0", resource_type=M.STREAM, severity="CRITICAL", auto_close_s=3600,
                   documentation="Stream ${metric.labels.stream_id} reports errors."),
            Policy("stream_backfill", "Datastream - Backfill Failures", M.BACKFILL_ERRORS, "threshold",
                   condition="Backfill error count > 0", resource_type=M.STREAM, severity="WARNING", auto_close_s=3600, documentation="Backfill errors detected."),
            Policy("stream_lag", "Datastream - High Replication Lag", M.STREAM_LATENCY, "threshold",
                   condition=f"Replication lag > {lag_threshold_s:g}s", resource_type=M.STREAM, aligner="ALIGN_PERCENTILE_99", threshold=lag_threshold_s, duration_s=300,
                   severity="WARNING", auto_close_s=3600,
                   documentation="Replication lag above threshold on ${metric.labels.stream_id}."),
        ]
    out += [
        Policy("bq_slot_time", "BigQuery - High Slot-Time Jobs", M.QUERY_TIMES, "threshold",
               condition=f"Job slot-seconds > {slot_time_threshold:g}", resource_type=M.PROJECT, aligner="ALIGN_PERCENTILE_99", threshold=slot_time_threshold, severity="WARNING",
               auto_close_s=3600, documentation="A job exceeded the slot-time threshold."),
        Policy("bq_scheduled_failures", "BigQuery - Scheduled Query Failures", M.SQ_FAILURES, "threshold",
               condition="Scheduled query failure count > 0", resource_type=M.GLOBAL, severity="CRITICAL", auto_close_s=1800,
               documentation="Scheduled query ${metric.labels.transfer_config_name} failed."),
    ]
    if monitored_datasets:   # E6 + Q8: one expected series per monitored dataset
        out.append(Policy("bq_freshness", "BigQuery - Data Freshness Stale", M.UPLOADED_ROWS, "absent",
                          condition=f"Table last modified time absent for {freshness_absent_s}s", resource_type=M.DATASET, duration_s=freshness_absent_s, severity="WARNING", auto_close_s=3600,
                          expected=tuple({"dataset_id": d} for d in monitored_datasets),
                          label_any={"dataset_id": tuple(monitored_datasets)},
                          documentation="Dataset ${metric.labels.dataset_id} has had no uploads."))
    return [p for p in out if p.enabled]


def _entries(d: dict) -> list[tuple[str, str]]:
    return sorted(d.items())


def policy_table(spark: SparkSession, policies: list[Policy]) -> DataFrame:
    for p in policies:
        series.check_spec(p.policy_id, p.aligner, p.reducer, p.comparison)
    rows = [(p.policy_id, p.name, p.condition, p.signal, p.kind, p.resource_type, dict(p.resource_labels), dict(p.label_filter), p.aligner, int(p.period_s),
             p.reducer, list(p.group_by), p.comparison, float(p.threshold), int(p.duration_s),
             p.severity, int(p.auto_close_s)) for p in policies]
    schema = ("spec_id string, policy_name string, condition_name string, signal string, kind string, "
              "resource_filter string, resource_label_filter map<string,string>, label_filter map<string,string>, aligner string, period_s int, reducer string, "
              "group_by array<string>, comparison string, threshold double, duration_s int, "
              "severity string, auto_close_s int")
    return local_table(spark, rows, schema)


def expected_table(spark: SparkSession, policies: list[Policy]) -> DataFrame:
    rows = []
    for p in policies:
        for lab in p.expected:
            keep = {k: v for k, v in lab.items() if p.reducer == "NONE" or k in p.group_by}
            rows.append((p.policy_id, [{"key": k, "value": v} for k, v in _entries(keep)]))
    return local_table(spark, rows, "spec_id string, series_key array<struct<key:string,value:string>>")


def policy_series(points: DataFrame, policies: list[Policy], cfg: DataFrame, exact: bool = False) -> DataFrame:
    """The aligned and reduced series of every policy; each source of the points is read once."""
    reduced = series.align_reduce_specs(points, cfg, exact, any(p.aligner.startswith("ALIGN_PERCENTILE_") for p in policies))
    for p in policies:
        for k, values in p.label_any.items():  # E6: only the configured streams and datasets
            reduced = reduced.filter((F.col("spec_id") != p.policy_id) | F.coalesce(F.col("labels")[k].isin(*values), F.lit(False)))
    return reduced


def evaluate_policies(points: DataFrame, policies: list[Policy], as_of, since=None,
                      exact: bool = False) -> dict[str, DataFrame]:
    """Evaluate every policy over ``points`` in one pass.

    Returns ``{"series", "episodes", "incidents", "notifications"}``.
    ``since`` starts the gap of expected series that never reported (default:
    earliest point time, which costs one extra pass over the points).
    ``exact=False`` (default) aligns percentile policies with
    ``percentile_approx``, whose per-group state is bounded; the monitored
    service's percentile aligners are approximate as well.
    """
    spark = points.sparkSession
    cfg = policy_table(spark, policies)
    meta = small_side(cfg.select("spec_id", "kind", "comparison", "threshold", "duration_s",
                                  "auto_close_s", "period_s"))
    reduced = policy_series(points, policies, cfg, exact)
    # Hold, absence and the expected series all read the aligned series, which is small: it is written once.
    path = scratch_path(spark, "policy-series")
    reduced.write.parquet(path)
    reduced = spark.read.schema(reduced.schema).parquet(path)
    joined = reduced.join(meta, "spec_id")
    keys = ["spec_id", "series_key", "duration_s", "auto_close_s"]

    # One windowed pass per series serves both condition kinds: the window
    # columns are computed over every aligned row and the kind filters come
    # after, so both branches read the same exchange.
    flagged = alerts.threshold_flags(joined, F.col("comparison"), F.col("threshold"))
    seq = alerts.condition_sequence(flagged, F.col("period_s"), keys=keys + ["kind", "period_s", "comparison"])
    hold = alerts.hold_from_sequence(seq.filter(F.col("kind") == "threshold"), F.col("period_s"),
                                     F.col("duration_s"), keys=keys + ["period_s", "comparison"])
    # The worst value: of a policy that fires below its threshold the lowest.
    worst = F.when(F.col("comparison").isin("COMPARISON_LT", "COMPARISON_LE"), F.col("low_value")).otherwise(F.col("peak_value"))
    hold = hold.select(*keys, "episode_start", "fired_at", "episode_end", worst.alias("peak_value"))

    absent_cfg = [p for p in policies if p.kind == "absent"]
    start = since if since is not None else points.select(F.min("ts")).scalar()
    expected = None
    if absent_cfg:
        expected = expected_table(spark, absent_cfg).join(
            meta.select("spec_id", "duration_s", "auto_close_s"), "spec_id")
    gaps = alerts.absence_from_sequence(seq.filter(F.col("kind") == "absent"), F.col("duration_s"), as_of,
                                        expected=expected, since=start, keys=keys)
    gaps = gaps.select(*keys, "episode_start", "fired_at", "episode_end",
                       F.lit(None).cast("double").alias("peak_value"))
    episodes = hold.unionByName(gaps)
    inc = alerts.incidents(episodes, F.col("auto_close_s"), keys=keys)

    names = small_side(cfg.select("spec_id", "policy_name", "condition_name", "severity"))
    labels = F.map_from_entries("series_key")
    message = F.lit("")
    for p in policies:
        var_keys = {k for k in ("dag_id", "task_id", "alert_type", "stream_id", "transfer_config_name",
                                "dataset_id") if f"${{metric.labels.{k}}}" in p.documentation}
        text = render_template(p.documentation, {f"metric.labels.{k}": labels[k] for k in var_keys})
        message = F.when(F.col("spec_id") == p.policy_id, text).otherwise(message)
    notes = (inc.join(names, "spec_id")
                .select(F.col("spec_id").alias("policy_id"), "policy_name", "condition_name", "severity", labels.alias("labels"),
                        "incident_seq", "opened_at", "resolved_at", "episodes", message.alias("message")))
    return {"series": reduced, "episodes": episodes, "incidents": inc, "notifications": notes}
