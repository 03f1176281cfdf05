"""One-pass policy evaluation equals evaluating each policy on its own; E6 gating."""
from pyspark.sql import functions as F

from ledgerwatch.operators import alerts, series
from ledgerwatch.plans import panels, policies
from ledgerwatch.sources import fixtures as fx
from ledgerwatch.sources.contracts import METRIC_POINTS

SF = "/root/testdata/sf0.001"
AS_OF = "2024-02-01 00:00:00"


def test_gating():
    assert len(policies.monitoring_policies("e")) == 10
    assert len(policies.monitoring_policies("e", ["s1"])) == 14
    assert len(policies.monitoring_policies("e", ["s1"], ["d"])) == 15
    # 34 panels; the memory and slot charts plot two data sets each -> 36 specs
    assert len(panels.dashboard_panels("e")) == 36


def _single(points, p, start):
    pts = points.filter(F.col("metric") == p.signal)
    if p.resource_type:
        pts = pts.filter(F.col("resource_type") == p.resource_type)
    for k, v in p.resource_labels.items():
        pts = pts.filter(F.col("resource_labels")[k] == v)
    for k, values in p.label_any.items():
        pts = pts.filter(F.col("labels")[k].isin(*values))
    for k, v in p.label_filter.items():
        pts = pts.filter(F.col("labels")[k] == v)
    al = series.align(pts, p.period_s, p.aligner, streaming_window=False, exact=False)
    red = al if p.reducer == "NONE" else series.reduce(al, p.reducer, list(p.group_by))
    if p.kind == "threshold":
        ep = alerts.hold_episodes(alerts.threshold_flags(red, p.comparison, p.threshold), p.period_s, p.duration_s)
    else:
        exp = None
        if p.expected:
            exp = points.sparkSession.createDataFrame(
                [(p.signal, [{"key": k, "value": v} for k, v in sorted(e.items())]) for e in p.expected],
                "metric string, series_key array<struct<key:string,value:string>>")
        ep = alerts.absence_episodes(red, p.duration_s, AS_OF, expected=exp, since=start)
    return sorted((str(r["series_key"]), r["fired_at"]) for r in ep.collect())


def test_one_pass_equals_per_policy(spark):
    pts = fx.monitoring_points(spark, SF).cache()
    pol = policies.monitoring_policies(fx.ENV_NAME, fx.STREAM_IDS, fx.DATASETS, slot_time_threshold=300)
    out = policies.evaluate_policies(pts, pol, AS_OF, exact=False)
    ep = out["episodes"].collect()
    start = pts.select(F.min("ts")).first()[0]
    for p in pol:
        got = sorted((str(r["series_key"]), r["fired_at"]) for r in ep if r["spec_id"] == p.policy_id)
        assert got == _single(pts, p, start), p.policy_id
    notes = out["notifications"].filter(F.col("policy_id") == "composer_error_logs").first()
    assert notes["message"].startswith(f"Error logs in environment '{fx.ENV_NAME}': DAG ") and notes["condition_name"] == "Error log count > 0"


def test_specs_take_only_points_of_their_resource(spark):
    import datetime as dt
    at = dt.datetime(2024, 1, 1)
    rows = [("m", "cloud_composer_environment", {"environment_name": e}, {}, at, v) for e, v in (("mine", 1.0), ("other", 100.0))]
    rows += [("m", "bigquery_project", {"environment_name": "mine"}, {}, at, 1000.0), ("m", None, None, {}, at, 10000.0)]
    points = spark.createDataFrame(rows, METRIC_POINTS)
    pol = [policies.Policy("own", "n", "m", "threshold", resource_type="cloud_composer_environment", resource_labels={"environment_name": "mine"}),
           policies.Policy("any", "n", "m", "threshold")]
    out = policies.evaluate_policies(points, pol, dt.datetime(2024, 1, 2), since=at)["episodes"].collect()
    assert {r["spec_id"]: r["peak_value"] for r in out} == {"own": 1.0, "any": 11101.0}
    bare = points.drop("resource_type", "resource_labels")  # points that do not say where they come from
    out = policies.evaluate_policies(bare, pol, dt.datetime(2024, 1, 2), since=at)["episodes"].collect()
    assert {r["spec_id"] for r in out} == {"any"}


def test_every_panel_has_rows_and_leaves_out_the_other_environment(spark):
    specs = panels.dashboard_panels(fx.ENV_NAME)
    own = panels.evaluate_panels(fx.monitoring_points(spark, SF), specs).groupBy("spec_id").agg(F.sum("value").alias("v")).collect()
    assert {r["spec_id"] for r in own} == {p.panel_id for p in specs}
    other = panels.evaluate_panels(fx.monitoring_points(spark, SF), panels.dashboard_panels(fx.OTHER_ENV))
    beats = other.filter("spec_id = 'composer_heartbeat'").agg(F.sum("value")).first()[0]
    views = fx.read_table(spark, SF, "events").filter("event_type = 'view'").count()
    assert beats and beats + {r["spec_id"]: r["v"] for r in own}["composer_heartbeat"] == views
