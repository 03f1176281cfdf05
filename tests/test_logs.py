"""Severity ordering, label extraction (Q3) and the failure record round trip."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerwatch.functions.scalar import render_template, severity_at_least
from ledgerwatch.operators import logs
from ledgerwatch.sources import tables
from ledgerwatch.sources.contracts import LOG_ENTRIES

T0 = dt.datetime(2024, 1, 1, 10, 0)
BODY = ('{"alert_type": "TASK_FAILURE", "source": "global_listener", "message": "m", '
        '"dag_id": "raw_to_silver", "task_id": "chaos_post_merge", "run_id": "r", "try_number": 1, '
        '"max_tries": 2, "execution_date": "", "log_url": "", "exception": "", "previous_state": "running", '
        '"operator": "PythonOperator", "duration": "", "timestamp": ""}')


def entries(spark, rows):
    return spark.createDataFrame(rows, LOG_ENTRIES)


def test_severity_at_least(spark):
    df = spark.createDataFrame([("INFO",), ("ERROR",), ("CRITICAL",), ("warning",), (None,)], "s string")
    got = [r[0] for r in df.select(severity_at_least("s", "ERROR")).collect()]
    assert got == [False, True, True, False, False]


def test_task_errors_json_vs_greedy_regex(spark):
    env = {"environment_name": "env"}
    df = entries(spark, [
        ("cloud_composer_environment", env, "ERROR", T0, BODY, None, None),
        ("cloud_composer_environment", env, "INFO", T0, BODY, None, None),
        ("cloud_composer_environment", {"environment_name": "other"}, "ERROR", T0, BODY, None, None)])
    m = logs.task_errors("env")
    js = logs.log_metric_counts(df, m).first()
    rx = logs.log_metric_counts(df, m, extract="regex").first()
    assert (js["dag_id"], js["task_id"], js["alert_type"], js["log_count"]) == \
        ("raw_to_silver", "chaos_post_merge", "TASK_FAILURE", 1)
    assert (rx["dag_id"], rx["task_id"], rx["alert_type"]) == ("w_to_silver", "aos_post_merge", "SK_FAILURE")


def test_all_metrics_one_pass_equals_separate(spark):
    import os
    from ledgerwatch.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    le = fx.log_entries(spark, sf)
    one = logs.all_log_metric_points(le, fx.ENV_NAME).groupBy("metric").count()
    sep = {m.name: logs.log_metric(le, m).count() for m in logs.all_log_metrics(fx.ENV_NAME)}
    got = {r["metric"]: r["count"] for r in one.collect()}
    assert got == {k: v for k, v in sep.items() if v}


def test_failure_record_round_trip(spark):
    df = entries(spark, [("cloud_composer_environment", {}, "ERROR", T0, BODY, None, None)])
    rec = tables.parse_failure_records(df)
    r = rec.first()
    assert r["dag_id"] == "raw_to_silver" and r["try_number"] == 1
    back = tables.failure_record_json(rec).first()["text_payload"]
    assert F is not None and '"task_id":"chaos_post_merge"' in back


def test_render_template(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    out = df.select(render_template("dag ${metric.labels.x} task ${metric.labels.y} ${other}",
                                    {"metric.labels.x": F.col("x"), "metric.labels.y": F.col("y")})).first()[0]
    assert out == "dag a task  ${other}"
