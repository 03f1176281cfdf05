"""DuckDB oracle SQL for the monitoring signals, panels and policies.

``monitoring_points_cte`` derives the signal points from ``events`` with the
fixture binding of ``sources.fixtures.monitoring_points`` (written again in
SQL).  Labels are a key-sorted ``list<struct<key, value>>``, the SQL form of
the Spark series key.  The specs are stated a second time in
``plans/oracle_specs.py``; the SQL evaluates each on its own (one SELECT per
spec, UNION ALL), so the one-pass evaluation is checked against a per-spec one.
"""

from __future__ import annotations

from ledgerwatch.plans.oracle_specs import ENV, PANEL_SPECS, POLICY_SPECS, SCORECARDS, TOP_PANELS
from ledgerwatch.plans.oracle_sql import JOB_LOG, _pick, log_entries_cte, log_metric_specs, wrap

KV = "STRUCT(key VARCHAR, value VARCHAR)"
_SEV_ERROR = "severity IN ('ERROR', 'CRITICAL', 'ALERT', 'EMERGENCY')"


def label_list(pairs: list[tuple[str, str]]) -> str:
    """Key-sorted label list; values are SQL expressions."""
    if not pairs:
        return f"[]::{KV}[]"
    return "[" + ", ".join(f"{{'key': '{k}', 'value': CAST({v} AS VARCHAR)}}" for k, v in sorted(pairs)) + "]"


def labels_json(col: str) -> str:
    """The label list as the JSON object Spark's ``to_json(map)`` writes."""
    return ("'{' || array_to_string(list_transform(" + col + ", lambda kv: '\"' || kv.key || '\":' || "
            "COALESCE('\"' || kv.value || '\"', 'null')), ',') || '}'")


def monitoring_points_cte() -> str:
    from ledgerwatch.sources.fixtures import DAG_IDS

    dag = _pick(DAG_IDS, "event_id")
    stream = [("stream_id", "'orders-stream-' || CAST(user_id % 4 AS VARCHAR)")]
    dataset = [("dataset_id", "CASE user_id % 3 WHEN 0 THEN 'orders_raw' WHEN 1 THEN 'orders_silver' ELSE 'scratch' END")]
    bucket = [("bucket_name", "CASE user_id % 2 WHEN 0 THEN 'orders-landing' ELSE 'orders-archive' END")]
    env = "CASE WHEN user_id % 5 = 4 THEN 'other-composer' ELSE 'orders-composer' END"
    environment, job = "cloud_composer_environment", "bigquery_project"
    workload, data = "cloud_composer_workload", "bigquery_dataset"
    flow, gcs, feed = "cloud_composer_workflow", "gcs_bucket", "datastream.googleapis.com/Stream"
    c, d, b, g = "composer.googleapis.com/", "datastream.googleapis.com/stream/", "bigquery.googleapis.com/", "storage.googleapis.com/"
    # (signal, event type, resource type, environment, labels, value)
    binding = [
        (c + "workflow/run_count", "error", flow, None, [("state", "'failed'"), ("workflow_name", dag)], "1.0"),
        (c + "workflow/run_count", "purchase", flow, None, [("state", "'success'"), ("workflow_name", dag)], "1.0"),
        (c + "environment/finished_task_instance_count", "click", environment, env,
         [("state", "CASE WHEN value > 40 THEN 'failed' ELSE 'success' END")], "1.0"),
        (c + "environment/scheduler_heartbeat_count", "view", environment, env, [], "1.0"),
        (c + "environment/worker/pod_eviction_count", "click", environment, env, [], "CAST(value > 45 AS DOUBLE)"),
        (c + "environment/database_health", "signup", environment, env, [], "CAST(value > 5.0 AS DOUBLE)"),
        (c + "environment/web_server/health", "click", environment, env, [], "CAST(value > 2.0 AS DOUBLE)"),
        (c + "environment/dagbag_size", "view", environment, env, [], "floor(value)"),
        (c + "environment/unfinished_task_instances", "click", environment, env, [], "floor(value)"),
        (c + "environment/scheduler/zombies_killed", "error", environment, env, [], "CAST(value > 40 AS DOUBLE)"),
        (c + "environment/dag_processing/total_parse_time", "signup", environment, env, [], "value"),
        (c + "workload/memory/bytes_used", "click", workload, env, [], "floor(value) * 1048576"),
        (c + "workload/memory/quota", "view", workload, env, [], "134217728"),
        (d + "event_count", "purchase", feed, None, stream, "1.0"),
        (d + "total_latencies", "view", feed, None, stream, "value * 60.0"),
        (d + "freshness", "click", feed, None, stream, "value"),
        (d + "unsupported_event_count", "error", feed, None, stream, "1.0"),
        (d + "bytes_count", "purchase", feed, None, stream, "floor(value) * 1024"),
        (b + "slots/total_available", "view", job, None, [], "floor(value) + 100"),
        (b + "slots/allocated_for_project", "purchase", job, None, [], "floor(value)"),
        (b + "job/num_in_flight", "click", job, None, [("state", "CASE WHEN value > 30 THEN 'pending' ELSE 'running' END")], "floor(value)"),
        (b + "query/scanned_bytes", "purchase", "global", None, [], "floor(value) * 1048576"),
        (b + "query/scanned_bytes_billed", "view", "global", None, [], "floor(value) * 10485760"),
        (b + "storage/uploaded_row_count", "signup", data, None, dataset, "value"),
        (b + "storage/uploaded_bytes", "signup", data, None, dataset, "floor(value) * 1024"),
        (b + "storage/stored_bytes", "click", data, None, dataset, "floor(value) * 1048576"),
        (b + "storage/table_count", "purchase", data, None, dataset, "floor(value)"),
        (g + "api/request_count", "view", gcs, None, bucket, "1.0"),
        (g + "network/sent_bytes_count", "click", gcs, None, bucket, "floor(value) * 2048"),
        (g + "storage/total_bytes", "signup", gcs, None, bucket, "floor(value) * 1048576"),
        (g + "storage/object_count", "purchase", gcs, None, bucket, "floor(value)"),
    ]
    parts = [f"SELECT '{sig}' AS metric, '{kind}' AS resource_type, CAST({where or 'NULL'} AS VARCHAR) AS env, {label_list(lab)} AS labels, ts, "
             f"CAST({val} AS DOUBLE) AS value FROM events WHERE event_type = '{et}'" for sig, et, kind, where, lab, val in binding]
    for name, (metric, where, labels) in log_metric_specs().items():
        if name == "l1_task_errors_regex_labels":
            continue
        parts.append(f"SELECT 'logging.googleapis.com/user/{metric}' AS metric, "
                     "CASE resource_type WHEN 'bigquery_resource' THEN 'global' ELSE resource_type END AS resource_type, NULL AS env, "
                     f"{label_list(list(labels.items()))} AS labels, ts, 1.0::DOUBLE AS value "
                     f"FROM log_entries WHERE {_SEV_ERROR} AND {where}")
    parts.append(f"SELECT 'bigquery.googleapis.com/query/execution_times' AS metric, 'bigquery_project' AS resource_type, NULL AS env, "
                 f"{label_list([])} AS labels, creation_time AS ts, "
                 "CAST(total_slot_ms AS DOUBLE) / 1000.0 AS value FROM job_log WHERE state = 'DONE'")
    union = "\n  UNION ALL ".join(parts)
    return f"{log_entries_cte()},{JOB_LOG},\nmonitoring_points AS MATERIALIZED (\n  {union}\n)"


def _aligner(aligner: str, period: int, approx: bool = False) -> str:
    a = aligner.upper().removeprefix("ALIGN_")
    if a in ("SUM", "DELTA"):
        return "SUM(value)"
    if a == "RATE":
        return f"SUM(value) / {float(period)}"
    if a == "MEAN":
        return "AVG(value)"
    if a in ("MAX", "MIN"):
        return f"{a}(value)"
    if a == "COUNT":
        return "CAST(COUNT(value) AS DOUBLE)"
    if a == "FRACTION_TRUE":
        return "AVG(CAST(value <> 0 AS DOUBLE))"
    if a == "NEXT_OLDER":
        return "arg_max(value, ts)"
    if a.startswith("PERCENTILE_"):
        q = int(a.split("_")[1]) / 100.0
        if approx:   # percentile_approx: smallest value with at least q of the values at or below it
            return f"list_sort(list(value))[CAST(greatest(ceil({q} * COUNT(value)), 1) AS BIGINT)]"
        return f"quantile_cont(value, {q})"
    raise ValueError(aligner)


def _reducer(reducer: str) -> str:
    r = reducer.upper().removeprefix("REDUCE_")
    return {"NONE": "SUM(value)", "SUM": "SUM(value)", "MAX": "MAX(value)", "MIN": "MIN(value)",
            "MEAN": "AVG(value)", "COUNT": "CAST(COUNT(value) AS DOUBLE)",
            "COUNT_TRUE": "SUM(CAST(value <> 0 AS DOUBLE))"}[r]


def spec_series_sql(spec_id: str, signal: str, resource: str, own_env: bool, state: str | None, aligner: str, period: int,
                    reducer: str, group_by, approx: bool = False, extra: str = "", among: tuple | None = None) -> str:
    """One spec on its own: filter, per-series alignment, cross-series reduction."""
    where = [f"metric = '{signal}'", f"resource_type = '{resource}'"]
    if own_env:
        where.append(f"env = '{ENV}'")
    if state:
        where.append(f"len(list_filter(labels, lambda kv: kv.key = 'state' AND kv.value = '{state}')) > 0")
    if among:
        values = "[" + ", ".join(f"'{v}'" for v in among[1]) + "]"
        where.append(f"len(list_filter(labels, lambda kv: kv.key = '{among[0]}' AND list_contains({values}, kv.value))) > 0")
    if reducer == "NONE":
        key = "series_key"
    else:
        keep = "[" + ", ".join(f"'{k}'" for k in group_by) + "]::VARCHAR[]"
        key = f"list_filter(series_key, lambda kv: list_contains({keep}, kv.key))"
    return f"""
  SELECT '{spec_id}' AS spec_id, {extra}{key} AS series_key, window_start,
         window_start + INTERVAL '{int(period)} seconds' AS window_end,
         CAST({_reducer(reducer)} AS DOUBLE) AS value, COUNT(value) AS series_count
  FROM (
    SELECT labels AS series_key, time_bucket(INTERVAL '{int(period)} seconds', ts) AS window_start,
           CAST({_aligner(aligner, period, approx)} AS DOUBLE) AS value
    FROM monitoring_points WHERE {' AND '.join(where)}
    GROUP BY labels, time_bucket(INTERVAL '{int(period)} seconds', ts)
  ) a
  GROUP BY {key}, window_start"""


# --------------------------------------------------------------------------- panels

def panel_series_cte() -> str:
    parts = [spec_series_sql(pid, signal, resource, own, state, aligner, period, reducer, group_by)
             for pid, signal, resource, own, aligner, period, reducer, group_by, state in PANEL_SPECS]
    return f"WITH {monitoring_points_cte()},\npanel_series AS ({' UNION ALL '.join(parts)}\n)"


def panel_series_sql() -> str:
    return wrap(panel_series_cte() + f"""
SELECT spec_id AS panel_id, {labels_json('series_key')} AS labels, window_start, window_end, value, series_count
FROM panel_series""", ["panel_id", "labels", "window_start", "window_end", "value", "series_count"], ["value"])


def panel_scorecards_sql() -> str:
    colour = "CASE " + " ".join(f"WHEN spec_id = '{pid}' AND {rules[c]} THEN '{c}'" for c in ("red", "yellow")
                                for pid, rules in SCORECARDS.items() if c in rules) + " ELSE 'green' END"
    ids = ", ".join(f"'{pid}'" for pid in SCORECARDS)
    return wrap(panel_series_cte() + f""",
latest AS (
  SELECT spec_id, series_key, arg_max(value, window_start) AS value, MAX(window_start) AS window_start
  FROM panel_series WHERE spec_id IN ({ids}) GROUP BY spec_id, series_key
)
SELECT spec_id AS panel_id, {labels_json('series_key')} AS labels, window_start, value, {colour} AS colour
FROM latest""", ["panel_id", "labels", "window_start", "value", "colour"], ["value"])


def panel_top_sql() -> str:
    limit = "CASE " + " ".join(f"WHEN spec_id = '{pid}' THEN {n}" for pid, n in TOP_PANELS.items()) + " ELSE 0 END"
    ids = ", ".join(f"'{pid}'" for pid in TOP_PANELS)
    return wrap(panel_series_cte() + f""",
totals AS (
  SELECT spec_id, series_key, SUM(value) AS total
  FROM panel_series WHERE spec_id IN ({ids}) GROUP BY spec_id, series_key
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY spec_id ORDER BY total DESC NULLS LAST, series_key) AS rank
  FROM totals
)
SELECT spec_id AS panel_id, {labels_json('series_key')} AS labels, total, rank
FROM ranked WHERE rank <= {limit}""", ["panel_id", "labels", "total", "rank"], ["total"])


# --------------------------------------------------------------------------- policies

def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _label_value(key: str) -> str:
    return f"(list_filter(series_key, lambda kv: kv.key = '{key}'))[1].value"


def _message(parts: tuple) -> str:
    """Texts and, between them, labels of the series ('' when missing)."""
    return " || ".join(f"COALESCE({_label_value(x)}, '')" if i % 2 else _sql_text(x) for i, x in enumerate(parts))


def policy_episodes_cte(as_of: str, since: str) -> str:
    """Every policy's episodes: hold runs of threshold policies and gaps of absence policies."""
    parts = []
    for p in POLICY_SPECS:
        meta = (f"'{p.kind}' AS kind, '{p.comparison}' AS comparison, {float(p.threshold)} AS threshold, "
                f"{p.duration_s} AS duration_s, {p.auto_close_s} AS auto_close_s, {p.period_s} AS period_s, ")
        parts.append(spec_series_sql(p.policy_id, p.signal, p.resource, p.own_env, p.state, p.aligner, p.period_s,
                                     p.reducer, p.group_by, approx=True, extra=meta, among=p.among))
    expected = []
    for p in POLICY_SPECS:
        if p.kind == "absent":
            for keep in [[(p.among[0], f"'{v}'")] for v in p.among[1]] if p.among else [[]]:
                expected.append(f"SELECT '{p.policy_id}' AS spec_id, {label_list(keep)} AS series_key, "
                                f"{p.duration_s} AS duration_s, {p.auto_close_s} AS auto_close_s")
    exp_sql = " UNION ALL ".join(expected)
    return f"""WITH {monitoring_points_cte()},
ps AS ({' UNION ALL '.join(parts)}
),
f AS (
  SELECT *, COALESCE(CASE comparison WHEN 'COMPARISON_GT' THEN value > threshold
                                     WHEN 'COMPARISON_LT' THEN value < threshold
                                     WHEN 'COMPARISON_GE' THEN value >= threshold
                                     WHEN 'COMPARISON_LE' THEN value <= threshold
                                     WHEN 'COMPARISON_EQ' THEN value = threshold
                                     WHEN 'COMPARISON_NE' THEN value <> threshold END, FALSE) AS violating
  FROM ps
),
s AS (
  SELECT *, lag(window_start) OVER w AS prev_start, lag(violating) OVER w AS prev_viol,
         lead(window_start) OVER w AS next_start
  FROM f WINDOW w AS (PARTITION BY spec_id, series_key ORDER BY window_start)
),
r AS (
  SELECT *, SUM(CASE WHEN violating AND NOT (COALESCE(window_start = prev_start + to_seconds(period_s), FALSE)
                                            AND COALESCE(prev_viol, FALSE)) THEN 1 ELSE 0 END)
              OVER (PARTITION BY spec_id, series_key ORDER BY window_start ROWS UNBOUNDED PRECEDING) AS run
  FROM s
),
hold AS (
  SELECT spec_id, series_key, auto_close_s, MIN(window_start) AS episode_start,
         MIN(window_start) + to_seconds(CAST(ceil(duration_s / period_s) AS BIGINT) * period_s) AS fired_at,
         MAX(window_start) AS last_start, MAX(window_end) AS episode_end,
         CASE WHEN comparison IN ('COMPARISON_LT', 'COMPARISON_LE') THEN MIN(value) ELSE MAX(value) END AS peak_value
  FROM r WHERE kind = 'threshold' AND violating
  GROUP BY spec_id, series_key, auto_close_s, duration_s, period_s, comparison, run
),
expected AS ({exp_sql}),
gaps AS (
  SELECT spec_id, series_key, auto_close_s, duration_s, window_end AS episode_start, next_start AS episode_end
  FROM s WHERE kind = 'absent'
  UNION ALL
  SELECT e.spec_id, e.series_key, e.auto_close_s, e.duration_s, TIMESTAMP '{since}', NULL::TIMESTAMP
  FROM expected e
  WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.kind = 'absent' AND s.spec_id = e.spec_id AND s.series_key = e.series_key)
),
episodes AS (
  SELECT spec_id, series_key, auto_close_s, episode_start, fired_at, episode_end, peak_value
  FROM hold WHERE fired_at <= last_start
  UNION ALL
  SELECT spec_id, series_key, auto_close_s, episode_start, episode_start + to_seconds(duration_s) AS fired_at,
         episode_end, NULL::DOUBLE AS peak_value
  FROM gaps WHERE episode_start + to_seconds(duration_s) <= COALESCE(episode_end, TIMESTAMP '{as_of}')
)"""


def policy_episodes_sql(as_of: str, since: str) -> str:
    return wrap(policy_episodes_cte(as_of, since) + f"""
SELECT spec_id AS policy_id, {labels_json('series_key')} AS labels, episode_start, fired_at, episode_end, peak_value
FROM episodes""", ["policy_id", "labels", "episode_start", "fired_at", "episode_end", "peak_value"], ["peak_value"])


def policy_notifications_sql(as_of: str, since: str) -> str:
    by_policy = lambda f: "CASE spec_id " + " ".join(f"WHEN '{p.policy_id}' THEN {f(p)}" for p in POLICY_SPECS) + " END"
    name, sev = by_policy(lambda p: _sql_text(p.name)), by_policy(lambda p: f"'{p.severity}'")
    condition, msg = by_policy(lambda p: _sql_text(p.condition)), by_policy(lambda p: _message(p.message))
    return policy_episodes_cte(as_of, since) + f""",
x AS (SELECT *, COALESCE(episode_end, TIMESTAMP '9999-12-31 00:00:00') AS e FROM episodes),
p AS (
  SELECT *, MAX(e) OVER (PARTITION BY spec_id, series_key ORDER BY fired_at, episode_start
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end
  FROM x
),
q AS (SELECT *, CASE WHEN prev_end IS NULL OR fired_at >= prev_end + to_seconds(auto_close_s) THEN 1 ELSE 0 END
                  AS nw FROM p),
t AS (SELECT *, SUM(nw) OVER (PARTITION BY spec_id, series_key ORDER BY fired_at, episode_start
                              ROWS UNBOUNDED PRECEDING) AS incident_seq FROM q),
inc AS (
  SELECT spec_id, series_key, incident_seq, MIN(fired_at) AS opened_at, MAX(e) AS e, COUNT(*) AS episodes
  FROM t GROUP BY spec_id, series_key, incident_seq
)
SELECT spec_id AS policy_id, {name} AS policy_name, {condition} AS condition_name, {sev} AS severity, {labels_json('series_key')} AS labels,
       CAST(incident_seq AS BIGINT) AS incident_seq, opened_at,
       CASE WHEN e = TIMESTAMP '9999-12-31 00:00:00' THEN NULL ELSE e END AS resolved_at,
       CAST(episodes AS BIGINT) AS episodes, {msg} AS message
FROM inc"""
