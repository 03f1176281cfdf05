"""Mergeable states: percentiles by rank error, file statistics against the full report."""
import datetime as dt
import os
import random

import pytest

from ledgerwatch.operators import report, sketches
from ledgerwatch.sources.tables import SilverTable
from test_maintained import raw

T0 = dt.datetime(2024, 1, 1)
DDL = "metric string, labels map<string,string>, ts timestamp_ntz, value double"


def test_merged_percentiles_keep_their_rank_error(spark):
    """Series of very different sizes and ranges; a hot one holds most points."""
    rng = random.Random(5)
    points = [("m", {"s": s, "z": "1"}, T0 + dt.timedelta(seconds=rng.randrange(7200)), rng.gauss(mean, 1 + mean))
              for s, mean, n in (("a", 0, 30000), ("b", 50, 4000), ("c", 1000, 300)) for _ in range(n)]
    states = sketches.percentile_states(spark.createDataFrame(points, DDL), 600)
    assert states.count() == 36
    values = sorted(v for *_, v in points)
    for merged in (sketches.merge_states(states, 7200, ()), sketches.merge_states(sketches.merge_states(states, 3600), 7200, ["z"])):
        row = sketches.percentiles(merged, {"p01": 0.01, "p50": 0.5, "p99": 0.99}).collect()
        assert len(row) == 1 and row[0]["n"] == len(values) and (row[0]["least"], row[0]["greatest"]) == (values[0], values[-1])
        for name, q in (("p01", 0.01), ("p50", 0.5), ("p99", 0.99)):
            below, upto = sum(v < row[0][name] for v in values), sum(v <= row[0][name] for v in values)
            assert below <= (q + sketches.RANK_ERROR) * len(values) and upto >= (q - sketches.RANK_ERROR) * len(values)


def test_small_states_are_exact_and_odd_values_have_no_rank(spark):
    points = [("m", {"s": "a"}, T0 + dt.timedelta(seconds=k), float(k)) for k in range(101)] + [
        ("m", {"s": "a"}, T0, None), ("m", {"s": "a"}, T0, float("nan")), ("m", {"s": "b"}, T0, None)]
    states = sketches.percentile_states(spark.createDataFrame(points, DDL), 60)
    found = {r["labels_s"]: r for r in sketches.percentiles(sketches.merge_states(states, 3600), {"p50": 0.5}).selectExpr(
        "*", "series_key[0].value as labels_s").collect()}
    assert (found["a"]["point_count"], found["a"]["n"], found["a"]["p50"], found["a"]["greatest"]) == (103, 101, 50.0, 100.0)
    assert (found["b"]["point_count"], found["b"]["n"], found["b"]["p50"]) == (1, 0, None)
    assert sketches.merge_states(sketches.percentile_states(spark.createDataFrame([], DDL), 60), 3600, ()).count() == 0


def test_file_statistics_follow_the_versions(spark, tmp_dir):
    rng = random.Random(3)
    silver = SilverTable(spark, os.path.join(tmp_dir, "silver"), rows_per_file=25)
    states = sketches.FileStatistics(spark, os.path.join(tmp_dir, "states"), silver)
    assert states.refresh() == {"files_read": 0, "rows_read": 0}
    as_of = "2024-06-01 00:00:00"
    versions = []
    for k in range(3):
        some = [(o, rng.choice(["a", "b", ""]), 0, rng.choice(["pending", ""]), "x", (o * 97) % 4000, 100 * k + rng.randrange(90))
                for o in (range(200) if k == 0 else [500 + k, 7 * k])]
        up = silver.upsert(raw(spark, some), f"2024-02-0{k + 1} 00:00:00")
        versions.append(up.version)
        if k < 2:
            read = states.refresh()
            assert read["rows_read"] < 200 if k else read["rows_read"] == 200
            assert states.refresh() == {"files_read": 0, "rows_read": 0}
    with pytest.raises(ValueError, match="refresh first"):
        states.quality(as_of)
    states.refresh()
    for v in versions:  # any version that SILVER still holds
        full = report.silver_quality(silver.read(v), as_of)
        got = states.quality(as_of, v)
        assert got.select(full.columns).collect() == full.collect()
        exact = silver.read(v).selectExpr("count(distinct customer_id)", "count(distinct product)").first()
        assert tuple(got.select("distinct_customers", "distinct_products").first()) == tuple(exact)
    silver.vacuum(keep=1)
    states.refresh()
    held = {r[0] for r in silver.manifest().select("file").collect()}
    assert {r[0] for r in states.read().select("file").collect()} == held  # states of forgotten files go
    assert states.quality(as_of).first()["total_rows"] == silver.read().count()
