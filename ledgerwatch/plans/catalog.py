"""Registered queries: one Spark callable and (where SQL can say it) one
DuckDB oracle string per operator of the inventory.

Every callable takes ``(spark, sf_dir)`` and reads the whole test tables;
``finish`` casts decimal outputs to double and rounds fractional outputs to six
places so both engines are compared on the same footing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.operators import alerts, audit, changes, combine, logs, maintained, marts, report, series, sketches, upsert
from ledgerwatch.operators.joins import local_table
from ledgerwatch.plans import oracle_signals as OS
from ledgerwatch.plans import oracle_sql as O
from ledgerwatch.plans import panels as PN
from ledgerwatch.plans import policies as PL
from ledgerwatch.session import scratch_path, staged
from ledgerwatch.sources import fixtures as fx
from ledgerwatch.sources import tables

Query = Callable[[SparkSession, str], DataFrame]


def finish(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), 6).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, columns: list[str] | None = None,
             fractional: list[str] = ()):
    def deco(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: finish(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = O.wrap(sql, columns, list(fractional)) if columns else sql
        return fn
    return deco


# --------------------------------------------------------------------------- orders pipeline

_BUS = O.BUSINESS.split(", ")
_SILVER_COLS = _BUS + ["_ingested_at", "_source", "order_date"]


@register("j1_latest_per_key",
          "WITH " + O.RAW_CTE + "," + O.latest_cte("all_latest") + "\nSELECT * FROM all_latest",
          _BUS, ["unit_price", "total_price"])
def q_latest(spark, sf_dir):
    return fx.latest_orders(spark, sf_dir)


@register("m1_merge_upsert", O.ORDERS_CTES + "\nSELECT * FROM merged",
          _SILVER_COLS + ["_action"], ["unit_price", "total_price"])
def q_merge(spark, sf_dir):
    return fx.silver_merged(spark, sf_dir, with_action=True)


@register("m1_merge_counts",
          O.ORDERS_CTES + "\nSELECT _action, COUNT(*) AS rows FROM merged GROUP BY _action")
def q_merge_counts(spark, sf_dir):
    return upsert.merge_counts(fx.silver_merged(spark, sf_dir, with_action=True))


@register("a1_revenue_by_product", O.ORDERS_CTES + O.REVENUE_MART,
          ["product", "region", "order_date", "order_count", "total_quantity", "total_revenue",
           "avg_order_value", "first_order", "last_order"], ["total_revenue", "avg_order_value"])
def q_revenue(spark, sf_dir):
    return marts.revenue_by_product(fx.silver_merged(spark, sf_dir))


@register("a2_order_status_summary", O.ORDERS_CTES + O.STATUS_MART,
          ["status", "region", "status_date", "order_count", "total_value", "avg_processing_minutes"],
          ["total_value", "avg_processing_minutes"])
def q_status(spark, sf_dir):
    return marts.order_status_summary(fx.silver_merged(spark, sf_dir))



def _marts(spark, sf_dir):
    silver = fx.silver_merged(spark, sf_dir)
    return silver, marts.revenue_by_product(silver), marts.order_status_summary(silver)


@register("a3_silver_quality", O.merged_query(O.SILVER_QUALITY))
def q_quality(spark, sf_dir):
    return report.silver_quality(fx.silver_merged(spark, sf_dir), fx.REPORT_AS_OF)


@register("a5_revenue_top", O.merged_query(O.REVENUE_TOP),
          ["product", "region", "total_orders", "total_quantity", "total_revenue", "avg_order_value"],
          ["total_revenue", "avg_order_value"])
def q_top(spark, sf_dir):
    return report.revenue_top(_marts(spark, sf_dir)[1], 10)


@register("a6_status_distribution", O.merged_query(O.STATUS_DIST),
          ["status", "total_orders", "total_value", "avg_processing_min"],
          ["total_value", "avg_processing_min"])
def q_status_dist(spark, sf_dir):
    return report.status_distribution(_marts(spark, sf_dir)[2])


@register("a7_report_summary", O.merged_query(O.REPORT_SUMMARY),
          ["report_date", "project_id", "total_rows", "null_order_ids", "null_customer_ids",
           "empty_products", "invalid_prices", "minutes_since_last_ingest", "freshness_ok",
           "top_total_revenue", "top_product", "top_product_count", "status_distribution"],
          ["minutes_since_last_ingest", "top_total_revenue"])
def q_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


def _summary(spark, sf_dir):
    """Three branches over one evaluation of SILVER."""
    silver = staged(fx.silver_merged(spark, sf_dir), "a7-silver")
    rev, st = marts.revenue_by_product(silver), marts.order_status_summary(silver)
    return report.report_summary(report.silver_quality(silver, fx.REPORT_AS_OF),
                                 report.revenue_top(rev, 10), report.status_distribution(st),
                                 fx.REPORT_DATE, fx.PROJECT_ID)


@register("a8_row_count", O.merged_query("SELECT COUNT(*) AS row_count FROM merged"))
def q_row_count(spark, sf_dir):
    return report.row_count(fx.silver_merged(spark, sf_dir))


@register("a4_freshness", O.merged_query(O.FRESHNESS))
def q_freshness(spark, sf_dir):
    dq = report.with_freshness(report.silver_quality(fx.silver_merged(spark, sf_dir), fx.REPORT_AS_OF))
    return dq.select("total_rows", "minutes_since_last_ingest", "freshness_ok")


@register("a5_revenue_top_weighted", O.merged_query(O.REVENUE_TOP_WEIGHTED),
          ["product", "region", "total_orders", "total_quantity", "total_revenue", "avg_order_value"],
          ["total_revenue", "avg_order_value"])
def q_top_weighted(spark, sf_dir):
    return report.revenue_top_weighted(_marts(spark, sf_dir)[1], 10)


@register("j1_latest_per_key_window",
          "WITH " + O.RAW_CTE + "," + O.latest_cte("all_latest") + "\nSELECT * FROM all_latest",
          _BUS, ["unit_price", "total_price"])
def q_latest_window(spark, sf_dir):
    raw = upsert.cast_projection(fx.raw_orders(spark, sf_dir), keep=["l_partkey", "l_suppkey", "l_linenumber"])
    valid, _ = upsert.split_rejects(raw)
    return upsert.latest_per_key(valid, "order_id", ["updated_at"] + fx.TIE_BREAK, method="window") \
        .select(*_BUS)


@register("s12_failure_records", O.failure_records_sql())
def q_failure_records(spark, sf_dir):
    return tables.parse_failure_records(fx.log_entries(spark, sf_dir))


# --------------------------------------------------------------------------- audits

@register("a9_slot_time_audit", O.SLOT_AUDIT,
          ["job_id", "project_id", "user_email", "job_type", "state", "creation_time", "end_time",
           "total_slot_seconds", "total_bytes_processed", "total_bytes_billed", "query"],
          ["total_slot_seconds"])
def q_slot(spark, sf_dir):
    return audit.slot_time_audit(fx.job_log(spark, sf_dir))


@register("a10_storage_comparison", O.STORAGE,
          ["snapshot_time", "dataset_id", "table_count", "total_logical_bytes", "total_physical_bytes",
           "compression_ratio", "est_monthly_cost_logical", "est_monthly_cost_physical",
           "recommended_billing_model"],
          ["compression_ratio", "est_monthly_cost_logical", "est_monthly_cost_physical"])
def q_storage(spark, sf_dir):
    return audit.storage_comparison(fx.table_storage(spark, sf_dir), fx.REPORT_AS_OF)


@register("j2_count_pairs", O.PAIR_COUNT, ["pair_count"], ["pair_count"])
def q_pairs(spark, sf_dir):
    return audit.count_pairs(fx.silver_merged(spark, sf_dir), "order_id")


@register("j2_count_pairs_repeated", O.ORDERS_CTES + """
SELECT CAST(SUM(n) AS DECIMAL(38,0)) * SUM(n) - SUM(CAST(n AS DECIMAL(38,0)) * n) AS pair_count
FROM (SELECT customer_id, COUNT(*) AS n FROM raw WHERE customer_id IS NOT NULL GROUP BY customer_id) k""",
          ["pair_count"], ["pair_count"])
def q_pairs_repeated(spark, sf_dir):
    """The same count on a key with many rows each: RAW lines by customer."""
    return audit.count_pairs(fx.raw_orders(spark, sf_dir), "customer_id")


# --------------------------------------------------------------------------- log metrics

_LOG_SQL = O.log_queries()


def _log_query(name: str, metric_fn, extract: str = "json"):
    def q(spark, sf_dir):
        return logs.log_metric_counts(fx.log_entries(spark, sf_dir), metric_fn(), 300, extract)
    register(name, _LOG_SQL[name])(q)


_log_query("l1_task_errors", lambda: logs.task_errors(fx.ENV_NAME))
_log_query("l1_task_errors_regex_labels", lambda: logs.task_errors(fx.ENV_NAME), "regex")
_log_query("l2_dag_parse_errors", lambda: logs.dag_parse_errors(fx.ENV_NAME))
_log_query("l3_scheduled_query_failures", logs.scheduled_query_failures)
_log_query("l4_stream_errors", logs.stream_errors)
_log_query("l5_backfill_errors", logs.backfill_errors)


# --------------------------------------------------------------------------- series

def _flat(df, label_keys=("user_id",), extra=("point_count",)):
    return df.select("metric", *[F.col("labels")[k].alias(k) for k in label_keys],
                     "window_start", "window_end", "value", *extra)


def _align_query(name: str, period: int, aligner: str, sql_agg: str, health: bool = False):
    def q(spark, sf_dir):
        pts = fx.metric_points(spark, sf_dir, health=health)
        return _flat(series.align(pts, period, aligner))
    register(name, O.align_sql(period, sql_agg, health))(q)


_align_query("t1_align_sum", 300, "ALIGN_SUM", "SUM(value)")
_align_query("t2_align_rate", 300, "ALIGN_RATE", "SUM(value) / 300.0")
_align_query("t3_align_mean_daily", 86400, "ALIGN_MEAN", "AVG(value)")
_align_query("t4_align_max", 300, "ALIGN_MAX", "MAX(value)")
_align_query("t5_align_p99", 300, "ALIGN_PERCENTILE_99", "quantile_cont(value, 0.99)")
_align_query("t6_align_fraction_true", 300, "ALIGN_FRACTION_TRUE",
             "AVG(CASE WHEN value <> 0 THEN 1.0 ELSE 0.0 END)", health=True)
_align_query("t7_align_delta_hourly", 3600, "ALIGN_DELTA", "SUM(value)")


_COUNTER_SQL = """
WITH n AS (SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS user_id, ts, value, event_id,
                  row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) // 20 AS life FROM events),
c AS (SELECT metric, user_id, ts, SUM(value) OVER (PARTITION BY metric, user_id, life ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value FROM n),
d AS (SELECT *, lag(value) OVER w AS pv, lag(ts) OVER w AS pt FROM c WINDOW w AS (PARTITION BY metric, user_id ORDER BY ts, value)),
i AS (SELECT *, CASE WHEN pv IS NULL THEN 0 WHEN value >= pv THEN value - pv ELSE value END AS rise FROM d),
s AS (SELECT *, unnest(generate_series(time_bucket(INTERVAL '1 hour', coalesce(pt, ts)), time_bucket(INTERVAL '1 hour', ts), INTERVAL '1 hour')) AS window_start
      FROM i)
SELECT metric, user_id, window_start, window_start + INTERVAL '1 hour' AS window_end,
       round(SUM(CASE WHEN pt IS NULL OR pt = ts THEN rise
                ELSE rise * (epoch_us(least(ts, window_start + INTERVAL '1 hour')) - epoch_us(greatest(pt, window_start))) / (epoch_us(ts) - epoch_us(pt)) END), 6) AS value
FROM s GROUP BY ALL"""


@register("t7_counter_delta", _COUNTER_SQL)
def q_counter_delta(spark, sf_dir):
    return _flat(series.counter_delta(fx.counter_points(spark, sf_dir), 3600), extra=())


_SKETCHED = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


@register("t5_percentile_states", """
SELECT event_type AS metric, date_trunc('day', ts)::TIMESTAMP AS window_start, date_trunc('day', ts)::TIMESTAMP + INTERVAL '1 day' AS window_end,
       COUNT(*) AS point_count, COUNT(value) AS n, round(MIN(value), 6) AS least, round(MAX(value), 6) AS greatest,
       TRUE AS p50_within, TRUE AS p90_within, TRUE AS p99_within
FROM events GROUP BY ALL""")
def q_percentile_states(spark, sf_dir):
    """Daily percentiles over all series, merged from hourly states of each; the points are read again only to tell whether every
    percentile's rank is within the stated error."""
    points = fx.metric_points(spark, sf_dir)
    states = staged(sketches.percentile_states(points, 3600), "t5-states")
    daily = staged(sketches.percentiles(sketches.merge_states(states, 86400, ()), _SKETCHED).drop("series_key"), "t5-daily")
    keys = [c for c in daily.columns if c not in _SKETCHED]
    seen = points.select(F.col("metric").alias("m"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "value")
    met = seen.join(daily, (F.col("m") == F.col("metric")) & (F.col("day") == F.col("window_start")))
    within = [sketches.rank_within(F.col("value"), F.col(c), q, F.col("n")).alias(f"{c}_within") for c, q in _SKETCHED.items()]
    return met.groupBy(*keys).agg(*within)


@register("t8_reduce_sum_by_label", f"""
WITH {O.log_entries_cte()},
m AS (
  SELECT json_extract_string(text_payload, '$.dag_id') AS dag_id,
         json_extract_string(text_payload, '$.task_id') AS task_id,
         time_bucket(INTERVAL '300 seconds', ts) AS window_start
  FROM log_entries
  WHERE severity IN ('ERROR', 'CRITICAL', 'ALERT', 'EMERGENCY')
    AND resource_type = 'cloud_composer_environment'
    AND resource_labels['environment_name'] = '{fx.ENV_NAME}'
    AND regexp_matches(text_payload, '"alert_type":\\s*"TASK_FAILURE"')
),
aligned AS (SELECT dag_id, task_id, window_start, CAST(COUNT(*) AS DOUBLE) AS value FROM m GROUP BY ALL)
SELECT 'composer_task_errors' AS metric, dag_id, window_start,
       window_start + INTERVAL '300 seconds' AS window_end,
       SUM(value) AS value, COUNT(*) AS series_count
FROM aligned GROUP BY ALL""")
def q_reduce_by_label(spark, sf_dir):
    pts = logs.log_metric(fx.log_entries(spark, sf_dir), logs.task_errors(fx.ENV_NAME))
    red = series.reduce(series.align(pts, 300, "ALIGN_SUM"), "REDUCE_SUM", ["dag_id"])
    return _flat(red, ("dag_id",), ("series_count",))


@register("t9_reduce_max", f"""
WITH {O.aligned_cte(300, "MAX(value)")}
SELECT metric, window_start, window_end, MAX(value) AS value, COUNT(*) AS series_count
FROM aligned GROUP BY ALL""")
def q_reduce_max(spark, sf_dir):
    red = series.reduce(series.align(fx.metric_points(spark, sf_dir), 300, "ALIGN_MAX"), "REDUCE_MAX")
    return _flat(red, (), ("series_count",))


@register("t10_top_series", f"""
WITH {O.aligned_cte(3600, "SUM(value)")}
SELECT metric, user_id, SUM(value) AS total, COUNT(*) AS windows
FROM aligned
GROUP BY metric, user_id
ORDER BY total DESC, metric, user_id LIMIT 10""", ["metric", "user_id", "total", "windows"], ["total"])
def q_top_series(spark, sf_dir):
    pts = fx.metric_points(spark, sf_dir)
    top = series.top_series(series.reduce(series.align(pts, 3600, "ALIGN_DELTA"), "REDUCE_SUM", ["user_id"]), 10)
    return top.select("metric", F.col("labels")["user_id"].alias("user_id"), "total", "windows")


@register("t11_reduce_sum_all", f"""
WITH {O.aligned_cte(300, "SUM(value)")}
SELECT metric, window_start, window_end, SUM(value) AS value, COUNT(*) AS series_count
FROM aligned GROUP BY ALL""")
def q_reduce_all(spark, sf_dir):
    red = series.reduce(series.align(fx.metric_points(spark, sf_dir), 300, "ALIGN_SUM"), "REDUCE_SUM")
    return _flat(red, (), ("series_count",))


@register("t12_scorecard", f"""
WITH {O.aligned_cte(300, "AVG(CASE WHEN value <> 0 THEN 1.0 ELSE 0.0 END)", health=True)},
reduced AS (SELECT metric, window_start, AVG(value) AS value FROM aligned GROUP BY ALL),
latest AS (SELECT metric, arg_max(value, window_start) AS value, MAX(window_start) AS window_start
           FROM reduced GROUP BY metric)
SELECT metric, window_start, value,
       CASE WHEN value < 0.5 THEN 'red' WHEN value < 0.9 THEN 'yellow' ELSE 'green' END AS colour
FROM latest""")
def q_scorecard(spark, sf_dir):
    al = series.align(fx.metric_points(spark, sf_dir, health=True), 300, "ALIGN_FRACTION_TRUE")
    card = series.scorecard(series.reduce(al, "REDUCE_MEAN"), "BELOW", yellow=0.9, red=0.5)
    return card.select("metric", "window_start", "value", "colour")


# --------------------------------------------------------------------------- alerts

ALERT_AS_OF = "2024-02-01 00:00:00"
ALERT_SINCE = "2024-01-01 00:00:00"
ALERT_THRESHOLD = 50.0


def _metric_series(spark, sf_dir, period=300):
    return series.reduce(series.align(fx.metric_points(spark, sf_dir), period, "ALIGN_SUM"), "REDUCE_SUM")


_REDUCED = f"""{O.aligned_cte(300, "SUM(value)")},
reduced AS (SELECT metric, window_start, window_end, SUM(value) AS value FROM aligned GROUP BY ALL)"""

_RUNS = f"""
WITH {_REDUCED},
v AS (SELECT * FROM reduced WHERE value > {ALERT_THRESHOLD}),
n AS (SELECT *, CASE WHEN lag(window_start) OVER (PARTITION BY metric ORDER BY window_start) IS NULL
                       OR window_start <> lag(window_start) OVER (PARTITION BY metric ORDER BY window_start)
                          + INTERVAL '300 seconds' THEN 1 ELSE 0 END AS nw FROM v),
r AS (SELECT *, SUM(nw) OVER (PARTITION BY metric ORDER BY window_start ROWS UNBOUNDED PRECEDING) AS run FROM n),
g AS (SELECT metric, run, MIN(window_start) AS episode_start, MAX(window_start) AS last_start,
             MAX(window_end) AS episode_end, COUNT(*) AS windows, MAX(value) AS peak_value
      FROM r GROUP BY metric, run)"""


@register("e1_threshold", f"""
WITH {_REDUCED}
SELECT metric, window_start, window_end, value, COALESCE(value > {ALERT_THRESHOLD}, FALSE) AS violating
FROM reduced""")
def q_threshold(spark, sf_dir):
    fl = alerts.threshold_flags(_metric_series(spark, sf_dir), "COMPARISON_GT", ALERT_THRESHOLD)
    return fl.select("metric", "window_start", "window_end", "value", "violating")


@register("e2_hold_episodes", _RUNS + """
SELECT metric, episode_start, episode_start + INTERVAL '300 seconds' AS fired_at, episode_end, windows, peak_value
FROM g WHERE episode_start + INTERVAL '300 seconds' <= last_start""")
def q_hold(spark, sf_dir):
    fl = alerts.threshold_flags(_metric_series(spark, sf_dir), "COMPARISON_GT", ALERT_THRESHOLD)
    ep = alerts.hold_episodes(fl, 300, 300)
    return ep.select("metric", "episode_start", "fired_at", "episode_end", "windows", "peak_value")


_GAPS = f"""
WITH {_REDUCED},
gaps AS (SELECT metric, window_end AS episode_start,
                lead(window_start) OVER (PARTITION BY metric ORDER BY window_start) AS episode_end
         FROM reduced),
ep AS (SELECT metric, episode_start, episode_start + INTERVAL '900 seconds' AS fired_at, episode_end
       FROM gaps
       WHERE episode_start + INTERVAL '900 seconds' <= COALESCE(episode_end, TIMESTAMP '{ALERT_AS_OF}'))"""


@register("e3_absence_episodes", _GAPS + "\nSELECT * FROM ep")
def q_absence(spark, sf_dir):
    ep = alerts.absence_episodes(_metric_series(spark, sf_dir), 900, ALERT_AS_OF)
    return ep.select("metric", "episode_start", "fired_at", "episode_end")


@register("e4_incidents", _GAPS + """,
x AS (SELECT *, COALESCE(episode_end, TIMESTAMP '9999-12-31 00:00:00') AS e FROM ep),
p AS (SELECT *, MAX(e) OVER (PARTITION BY metric ORDER BY fired_at, episode_start
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM x),
q AS (SELECT *, CASE WHEN prev_end IS NULL OR fired_at >= prev_end + INTERVAL '3600 seconds' THEN 1 ELSE 0 END AS nw
      FROM p),
s AS (SELECT *, SUM(nw) OVER (PARTITION BY metric ORDER BY fired_at, episode_start ROWS UNBOUNDED PRECEDING)
              AS incident_seq FROM q)
SELECT metric, incident_seq, MIN(fired_at) AS opened_at, MAX(fired_at) AS last_fired_at,
       CASE WHEN MAX(e) = TIMESTAMP '9999-12-31 00:00:00' THEN NULL ELSE MAX(e) END AS resolved_at,
       COUNT(*) AS episodes
FROM s GROUP BY metric, incident_seq""")
def q_incidents(spark, sf_dir):
    ep = alerts.absence_episodes(_metric_series(spark, sf_dir), 900, ALERT_AS_OF)
    inc = alerts.incidents(ep, 3600)
    return inc.select("metric", "incident_seq", "opened_at", "last_fired_at", "resolved_at", "episodes")


#: (policy, condition, metric, threshold of an hour's sum, series that must violate it) and each policy's combiner.
_CONDITIONS = [("both", "c1", "purchase", 60.0, 2), ("both", "c2", "error", 60.0, 1), ("any", "c1", "signup", 120.0, 1), ("any", "c2", "click", 90.0, 2),
               ("three", "c1", "view", 25.0, 1), ("three", "c2", "click", 25.0, 2), ("three", "c3", "signup", 25.0, 1)]
_COMBINERS = [("both", "AND"), ("any", "OR"), ("three", "AND")]
_COMBINED_SQL = f"""
WITH {O.aligned_cte(3600, "SUM(value)")},
cfg(policy_id, condition_id, metric, threshold, needed) AS (VALUES {", ".join(map(str, _CONDITIONS))}),
pol(policy_id, combiner) AS (VALUES {", ".join(map(str, _COMBINERS))}),
c AS (SELECT policy_id, condition_id, window_start FROM aligned JOIN cfg USING (metric) WHERE value > threshold
      GROUP BY policy_id, condition_id, needed, window_start HAVING COUNT(*) >= needed),
h AS (SELECT policy_id, window_start FROM c JOIN pol USING (policy_id) GROUP BY policy_id, combiner, window_start
      HAVING combiner = 'OR' OR COUNT(*) = (SELECT COUNT(*) FROM cfg WHERE cfg.policy_id = c.policy_id)),
i AS (SELECT *, window_start - to_hours(row_number() OVER (PARTITION BY policy_id ORDER BY window_start)) AS island FROM h)
SELECT policy_id, MIN(window_start) AS started_at, MAX(window_start) + INTERVAL '1 hour' AS ended_at FROM i GROUP BY policy_id, island"""


@register("e5_combined_conditions", _COMBINED_SQL)
def q_combined(spark, sf_dir):
    aligned = series.align(fx.metric_points(spark, sf_dir), 3600, "ALIGN_SUM")
    conditions = local_table(spark, _CONDITIONS, "policy_id string, condition_id string, on_metric string, threshold double, trigger_count int")
    met = aligned.join(F.broadcast(conditions), F.col("metric") == F.col("on_metric"))
    flagged = alerts.threshold_flags(met, "COMPARISON_GT", F.col("threshold"))
    episodes = alerts.hold_episodes(flagged, 3600, 0, keys=["policy_id", "condition_id", "series_key"])
    policies = local_table(spark, _COMBINERS, "policy_id string, combiner string")
    return combine.policy_intervals(episodes, conditions, policies)


# --------------------------------------------------------------------------- tables and sinks, written and read back

DRIFT_DAYS = 3
_DRIFTED = f"CASE WHEN _action = 'inserted' THEN created_at + INTERVAL '{DRIFT_DAYS} days' ELSE created_at END"


@register("m1_table_upsert", O.ORDERS_CTES + f"""
SELECT * REPLACE ({_DRIFTED} AS created_at, CAST({_DRIFTED} AS DATE) AS order_date) FROM merged""",
          _SILVER_COLS, ["unit_price", "total_price"])
def q_table_upsert(spark, sf_dir):
    """SILVER written twice; the second batch's versions carry a later ``created_at`` than the stored rows."""
    seed, incoming = fx.split_raw(fx.raw_orders(spark, sf_dir))
    silver = tables.SilverTable(spark, scratch_path(spark, "m1-silver"))
    silver.upsert(seed, fx.SEED_INGEST_TS, extra_order=fx.TIE_BREAK, batch_id="seed")
    later = F.col("created_at") + F.make_dt_interval(F.lit(DRIFT_DAYS))
    silver.upsert(incoming.withColumn("created_at", later), fx.INCOMING_INGEST_TS, extra_order=fx.TIE_BREAK, batch_id="incoming")
    return silver.read().select(*_SILVER_COLS)


@register("m1_table_version", O.ORDERS_CTES + """
SELECT *, CAST(created_at AS DATE) AS order_date FROM seed_silver""", _SILVER_COLS, ["unit_price", "total_price"])
def q_table_version(spark, sf_dir):
    """The version before the incoming batch, read after that batch is in."""
    seed, incoming = fx.split_raw(fx.raw_orders(spark, sf_dir))
    silver = tables.SilverTable(spark, scratch_path(spark, "m1-versions"))
    before = silver.upsert(seed, fx.SEED_INGEST_TS, extra_order=fx.TIE_BREAK, batch_id="seed").version
    silver.upsert(incoming, fx.INCOMING_INGEST_TS, extra_order=fx.TIE_BREAK, batch_id="incoming")
    return silver.read(version=before).select(*_SILVER_COLS)


_SKIPS = {"key": {"order_id": (500, 520)}, "cluster": {"region": ("ASIA", "ASIA"), "status": ("pending", "pending")},
          "dates": {"order_date": (dt.date(1996, 3, 1), dt.date(1996, 6, 30)), "region": ("EUROPE", "EUROPE")}}
_SKIP_SQL = {"key": "order_id BETWEEN 500 AND 520", "cluster": "region = 'ASIA' AND status = 'pending'",
             "dates": "order_date BETWEEN DATE '1996-03-01' AND DATE '1996-06-30' AND region = 'EUROPE'"}


@register("s6_data_skipping", O.ORDERS_CTES + ", seeded AS (SELECT *, CAST(created_at AS DATE) AS order_date FROM seed_silver)" + " UNION ALL".join(
    f"\nSELECT '{name}' AS filter, COUNT(*) AS row_count, SUM(quantity)::BIGINT AS quantity, TRUE AS opens_half_the_files_at_most FROM seeded WHERE {where}"
    for name, where in _SKIP_SQL.items()))
def q_data_skipping(spark, sf_dir):
    """Filters on the cluster columns: their rows, and whether the manifest ruled out half of the files or more."""
    seed, _ = fx.split_raw(fx.raw_orders(spark, sf_dir))
    rows = report.row_count(fx.silver_seed(spark, sf_dir)).first()[0]
    silver = tables.SilverTable(spark, scratch_path(spark, "s6-skipping"), rows_per_file=max(1, rows // 64))
    silver.upsert(seed, fx.SEED_INGEST_TS, extra_order=fx.TIE_BREAK, batch_id="seed")
    n_files, out = len(silver.files()), None
    for name, where in _SKIPS.items():
        found = silver.read(where=where).agg(F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("quantity")).select(
            F.lit(name).alias("filter"), "row_count", "quantity", F.lit(2 * len(silver.files(where=where)) <= n_files).alias("opens_half_the_files_at_most"))
        out = found if out is None else out.unionByName(found)
    return out


#: Days from the fixture's epoch at which the change feed begins, and between the backfill's chunks; half a window behind its low end a chunk is read.
FEED_START, CHUNK_EVERY, CHUNK_HALF = 250, 60, 20
_DAY = 100_000_000_000


@register("s3_change_records", "WITH " + O.RAW_CTE + f"""
SELECT {O.BUSINESS} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY date_diff('minute', created_at, updated_at) DESC, l_partkey DESC, l_linenumber DESC) AS rn
  FROM raw) x WHERE rn = 1 AND quantity <> 7""", _BUS, ["unit_price", "total_price"])
def q_change_records(spark, sf_dir):
    """RAW lines as a log in which quantity 7 deletes the order: its later part comes as events out of order and partly twice, its
    earlier part only in the chunks of a backfill that ran meanwhile."""
    raw = upsert.cast_projection(fx.raw_orders(spark, sf_dir), keep=["l_partkey", "l_linenumber"])
    place = (F.expr("timestampdiff(MINUTE, created_at, updated_at)") + 2000) * _DAY + F.col("l_partkey") * 1000 + F.col("l_linenumber")
    path = scratch_path(spark, "s3-log")
    raw.select(*_BUS, place.alias("position"), F.when(F.col("quantity") == 7, changes.DELETE).otherwise(changes.UPDATE).alias("op"),
               F.pmod(F.xxhash64("order_id", "l_linenumber"), F.lit(3)).alias("batch")).write.parquet(path)
    log = spark.read.parquet(path)
    start = (FEED_START + 2000) * _DAY
    feed = log.filter(F.col("position") > start)
    batch = lambda k: changes.events(feed.filter(F.col("batch") == k), F.col("op"), F.col("position"))

    def chunk(k):
        low = start + k * CHUNK_EVERY * _DAY
        seen = log.filter((F.col("position") <= low + CHUNK_HALF * _DAY) & (F.pmod("order_id", F.lit(4)) == k))
        state = upsert.latest_per_key(seen, "order_id", ["position"]).filter(F.col("op") != changes.DELETE)
        return changes.chunk(state, low, low + 2 * CHUNK_HALF * _DAY)

    replica = changes.ReplicaTable(spark, scratch_path(spark, "s3-replica"))
    for records in (batch(1).unionByName(chunk(0)), batch(2).unionByName(chunk(1)).unionByName(chunk(3)), batch(0).unionByName(chunk(2)), batch(1)):
        replica.apply(records)
    return replica.current()


def _maintained(spark, sf_dir, definition, name):
    """A mart that follows SILVER through three batches, refreshed behind each."""
    seed, incoming = fx.split_raw(fx.raw_orders(spark, sf_dir))
    silver = tables.SilverTable(spark, scratch_path(spark, f"{name}-silver"))
    mart = maintained.MaintainedMart(spark, scratch_path(spark, f"{name}-mart"), silver, definition)
    half = F.pmod("order_id", F.lit(2))
    for k, (rows, ts) in enumerate(((seed, fx.SEED_INGEST_TS), (incoming.filter(half == 0), fx.INCOMING_INGEST_TS), (incoming.filter(half == 1), fx.INCOMING_INGEST_TS))):
        silver.upsert(rows, ts, extra_order=fx.TIE_BREAK, batch_id=str(k))
        mart.refresh()
    return mart.mart()


@register("a1_revenue_maintained", O.ORDERS_CTES + O.REVENUE_MART,
          ["product", "region", "order_date", "order_count", "total_quantity", "total_revenue",
           "avg_order_value", "first_order", "last_order"], ["total_revenue", "avg_order_value"])
def q_revenue_maintained(spark, sf_dir):
    return _maintained(spark, sf_dir, maintained.revenue_definition(), "a1")


@register("a2_status_maintained", O.ORDERS_CTES + O.STATUS_MART,
          ["status", "region", "status_date", "order_count", "total_value", "avg_processing_minutes"],
          ["total_value", "avg_processing_minutes"])
def q_status_maintained(spark, sf_dir):
    return _maintained(spark, sf_dir, maintained.status_definition(), "a2")


@register("a3_quality_states", O.merged_query(f"""
SELECT q.*, TRUE AS customers_within, TRUE AS products_within, TRUE AS reads_new_files_only FROM ({O.SILVER_QUALITY}) q"""))
def q_quality_states(spark, sf_dir):
    """The quality report of SILVER behind two batches, merged from the states of its files; whether its distinct counts are within
    the stated error, and whether the second refresh read the files that the second batch wrote and no other."""
    seed, incoming = fx.split_raw(fx.raw_orders(spark, sf_dir))
    silver = tables.SilverTable(spark, scratch_path(spark, "a3-silver"))
    states = sketches.FileStatistics(spark, scratch_path(spark, "a3-states"), silver)
    first = silver.upsert(seed, fx.SEED_INGEST_TS, extra_order=fx.TIE_BREAK, batch_id="seed")
    states.refresh()
    second = silver.upsert(incoming, fx.INCOMING_INGEST_TS, extra_order=fx.TIE_BREAK, batch_id="incoming")
    read = states.refresh()
    came = silver.manifest(second.version).join(silver.manifest(first.version).select("file"), "file", "left_anti")
    exact = silver.read().agg(F.count_distinct("customer_id").alias("c"), F.count_distinct("product").alias("p"))
    within = lambda found, true: F.abs(F.col(found) - F.col(true)) <= sketches.DISTINCT_ERROR * F.col(true)
    return states.quality(fx.REPORT_AS_OF).join(exact).join(came.agg(F.sum("rows").alias("r"), F.count(F.lit(1)).alias("f"))).select(
        "total_rows", "null_order_ids", "null_customer_ids", "empty_products", "invalid_prices", "empty_statuses", "earliest_order", "latest_order",
        "last_ingestion", "minutes_since_last_ingest", within("distinct_customers", "c").alias("customers_within"),
        within("distinct_products", "p").alias("products_within"),
        ((F.col("r") == read["rows_read"]) & (F.col("f") == read["files_read"])).alias("reads_new_files_only"))


@register("s7_rejects", O.ORDERS_CTES + """
SELECT order_id, customer_id, product, quantity, l_partkey, l_suppkey, l_linenumber,
       'null:' || CASE WHEN region = 'ASIA' THEN 'status,region' ELSE 'status' END AS reason
FROM raw WHERE quantity = 13""")
def q_rejects(spark, sf_dir):
    broken = F.col("quantity") == 13
    raw = fx.raw_orders(spark, sf_dir).withColumn("status", F.when(~broken, F.col("status")))
    raw = raw.withColumn("region", F.when(~(broken & (F.col("region") == "ASIA")), F.col("region")))
    keep = ["l_partkey", "l_suppkey", "l_linenumber"]
    _, rejects = upsert.split_rejects(upsert.cast_projection(raw, keep=keep))
    return rejects.select("order_id", "customer_id", "product", "quantity", *keep, F.col("_reject_reason").alias("reason"))


@register("s9_mart_table", O.ORDERS_CTES + O.REVENUE_MART,
          ["product", "region", "order_date", "order_count", "total_quantity", "total_revenue",
           "avg_order_value", "first_order", "last_order"], ["total_revenue", "avg_order_value"])
def q_mart_table(spark, sf_dir):
    # the mart is evaluated once and written twice
    mart, path = staged(marts.revenue_by_product(fx.silver_merged(spark, sf_dir)), "s9-fresh"), scratch_path(spark, "s9-mart")
    for _ in range(2):  # the second write replaces the first
        marts.write_mart(mart, path)
    return spark.read.parquet(path)


@register("s10_report_table", O.STORAGE, ["dataset_id", "table_count", "total_logical_bytes", "recommended_billing_model"])
def q_report_table(spark, sf_dir):
    path = scratch_path(spark, "s10-report")
    for _ in range(2):
        tables.write_report(audit.storage_comparison(fx.table_storage(spark, sf_dir), fx.REPORT_AS_OF), path)
    return spark.read.parquet(path).select("dataset_id", "table_count", "total_logical_bytes", "recommended_billing_model")


_REPORT_FIELDS = {"report_date": ("$.report_date", "string"), "project_id": ("$.project_id", "string"), **{
    f: (f"$.data_quality.{f}", t) for f, t in (("total_rows", "bigint"), ("null_order_ids", "bigint"), ("null_customer_ids", "bigint"),
                                              ("empty_products", "bigint"), ("invalid_prices", "bigint"), ("minutes_since_last_ingest", "double"),
                                              ("freshness_ok", "boolean"))},
    "top_total_revenue": ("$.revenue.total_revenue", "double"), "top_product": ("$.revenue.top_product", "string"),
    "top_product_count": ("$.revenue.product_count", "bigint"), "status_distribution": ("$.status_distribution", "string")}


@register("s13_json_report", O.merged_query(O.REPORT_SUMMARY), list(_REPORT_FIELDS), ["minutes_since_last_ingest", "top_total_revenue"])
def q_json_report(spark, sf_dir):
    path = scratch_path(spark, "s13-report")
    tables.write_json_report(report.summary_json(_summary(spark, sf_dir), fx.REPORT_AS_OF), path)
    return spark.read.text(path).select(*[F.get_json_object("value", p).cast(t).alias(name) for name, (p, t) in _REPORT_FIELDS.items()])


# --------------------------------------------------------------------------- policies and panels


def _policy_outputs(spark, sf_dir):
    pol = PL.monitoring_policies(fx.ENV_NAME, fx.STREAM_IDS, fx.DATASETS)
    pts = fx.monitoring_points(spark, sf_dir, {p.signal for p in pol})
    return PL.evaluate_policies(pts, pol, ALERT_AS_OF, since=ALERT_SINCE)


@register("e5_policy_episodes", OS.policy_episodes_sql(ALERT_AS_OF, ALERT_SINCE))
def q_policy_episodes(spark, sf_dir):
    ep = _policy_outputs(spark, sf_dir)["episodes"]
    return ep.select(F.col("spec_id").alias("policy_id"), F.to_json(F.map_from_entries("series_key")).alias("labels"),
                     "episode_start", "fired_at", "episode_end", "peak_value")


@register("e8_policy_notifications", OS.policy_notifications_sql(ALERT_AS_OF, ALERT_SINCE))
def q_policy_notes(spark, sf_dir):
    n = _policy_outputs(spark, sf_dir)["notifications"]
    return n.select("policy_id", "policy_name", "condition_name", "severity", F.to_json("labels").alias("labels"), "incident_seq",
                    "opened_at", "resolved_at", "episodes", "message")


_PANELS = PN.dashboard_panels(fx.ENV_NAME)


def _panel_series(spark, sf_dir, panels=_PANELS):
    return PN.evaluate_panels(fx.monitoring_points(spark, sf_dir, {p.signal for p in panels}), panels)


@register("p1_panel_series", OS.panel_series_sql())
def q_panels(spark, sf_dir):
    ps = _panel_series(spark, sf_dir)
    return ps.select(F.col("spec_id").alias("panel_id"), F.to_json("labels").alias("labels"), "window_start",
                     "window_end", "value", "series_count")


@register("p2_panel_scorecards", OS.panel_scorecards_sql())
def q_scorecards(spark, sf_dir):
    panels = [p for p in _PANELS if p.scorecard]
    cards = PN.scorecards(_panel_series(spark, sf_dir, panels), panels)
    return cards.select(F.col("spec_id").alias("panel_id"), F.to_json("labels").alias("labels"),
                        "window_start", "value", "colour")


@register("p3_panel_top_series", OS.panel_top_sql())
def q_top_panels(spark, sf_dir):
    panels = [p for p in _PANELS if p.top_n]
    top = PN.top_panels(_panel_series(spark, sf_dir, panels), panels)
    return top.select(F.col("spec_id").alias("panel_id"), F.to_json("labels").alias("labels"), "total", "rank")
