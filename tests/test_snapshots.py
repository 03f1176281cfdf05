"""Versions of a table: isolation of readers, crashes, two writers, data skipping, vacuum."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerwatch.sources import fixtures as fx
from ledgerwatch.sources.snapshots import CommitConflict, SnapshotTable
from ledgerwatch.sources.tables import SilverTable
from test_silver_upsert import raw, state

SF = "/root/testdata/sf0.001"


def test_a_reader_keeps_its_version(spark, tmp_dir):
    t = SilverTable(spark, os.path.join(tmp_dir, "silver"))
    first = t.upsert(raw(spark, (1, 0, 0, "a"), (2, 1, 0, "a")), "2024-02-01 00:00:00")
    reader = t.read()  # resolved before the next commit, run behind it
    second = t.upsert(raw(spark, (1, 0, 5, "b"), (3, 2, 0, "n")), "2024-02-02 00:00:00")
    assert second.version == first.version + 1
    assert sorted((r["order_id"], r["status"]) for r in reader.collect()) == [(1, "a"), (2, "a")]
    assert sorted(r["order_id"] for r in t.read(first.version).collect()) == [1, 2]
    assert state(t) == [(1, "b", 1), (2, "a", 2), (3, "n", 3)]
    replay = t.upsert(raw(spark, (1, 0, 5, "b")), "2024-02-03 00:00:00")
    assert replay.version == second.version == t.latest()  # nothing new, no version


def test_a_crash_before_the_publication_changes_nothing(spark, tmp_dir, monkeypatch):
    t = SilverTable(spark, os.path.join(tmp_dir, "silver"))
    t.upsert(raw(spark, (1, 0, 0, "a")), "2024-02-01 00:00:00")
    want, version = state(t), t.latest()

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr("ledgerwatch.sources.snapshots.Files.publish", crash)
        with pytest.raises(OSError):
            t.upsert(raw(spark, (1, 0, 5, "b")), "2024-02-02 00:00:00")
    assert state(t) == want and t.latest() == version
    t.upsert(raw(spark, (1, 0, 5, "b")), "2024-02-02 00:00:00")
    assert state(t) == [(1, "b", 1)]


def test_of_two_writers_on_a_version_one_wins(spark, tmp_dir, monkeypatch):
    t = SilverTable(spark, os.path.join(tmp_dir, "silver"))
    t.upsert(raw(spark, (1, 0, 0, "a")), "2024-02-01 00:00:00")
    base = t.latest()
    assert t.commit(base, t.manifest(base)) == base + 1
    with pytest.raises(CommitConflict):
        t.commit(base, t.manifest(base))
    # a writer that is overtaken between its read and its commit merges anew into the version that won
    other, calls = SilverTable(spark, t.path), []
    replace = SilverTable.replace

    def overtaken(self, *args):
        if not calls:
            calls.append(1)
            other.upsert(raw(spark, (1, 0, 3, "between"), (2, 0, 0, "n")), "2024-02-02 00:00:00")
        return replace(self, *args)

    monkeypatch.setattr(SilverTable, "replace", overtaken)
    t.upsert(raw(spark, (1, 0, 2, "late"), (3, 0, 0, "m")), "2024-02-03 00:00:00")
    assert state(t) == [(1, "between", 1), (2, "n", 1), (3, "m", 1)]


def test_filters_open_a_fraction_of_the_files(spark, tmp_dir):
    silver = fx.silver_seed(spark, SF)
    n = silver.count()
    t = SilverTable(spark, os.path.join(tmp_dir, "silver"), rows_per_file=max(1, n // 256))
    t.create_if_missing()
    path = os.path.join(tmp_dir, "rows")
    silver.write.parquet(path)
    t.commit(t.latest(), t.write_files(spark.read.schema(t.schema).parquet(path), n))
    whole = t.read()
    assert len(t.files()) >= 128 and whole.count() == n
    some = whole.orderBy("order_id").first()
    for where, most in (({"order_id": (some["order_id"], some["order_id"])}, 0.5), ({"region": (some["region"],) * 2, "status": (some["status"],) * 2}, 0.5),
                        ({"order_date": (dt.date(1996, 1, 1), dt.date(1996, 3, 31))}, 0.5), ({"order_id": (None, 100)}, 0.5), ({"region": ("ZZZ", None)}, 0)):
        want = whole
        for c, (low, high) in where.items():
            want = want.filter((F.col(c) >= F.lit(low)) if low is not None else F.lit(True)).filter((F.col(c) <= F.lit(high)) if high is not None else F.lit(True))
        assert sorted(t.read(where=where).collect()) == sorted(want.collect())
        assert len(t.files(where=where)) <= most * len(t.files())


def test_optimize_and_vacuum(spark, tmp_dir):
    t = SilverTable(spark, os.path.join(tmp_dir, "silver"), rows_per_file=4)
    for k in range(4):
        t.upsert(raw(spark, (k, k, 0, "a"), (0, 0, k + 1, f"s{k}")), "2024-02-01 00:00:00")
    want = state(t)
    t.optimize()
    assert state(t) == want and len(t.files()) == 1
    t.vacuum(keep=1)
    assert state(t) == want and t.versions() == [t.latest()]
    assert len([f for _, _, names in os.walk(os.path.join(t.path, "data")) for f in names if f.endswith(".parquet")]) == 1
    t.vacuum(keep=3)
    assert state(t) == want


def test_empty_and_null_values_in_statistics(spark, tmp_dir):
    t = SnapshotTable(spark, os.path.join(tmp_dir, "t"), spark.createDataFrame([], "a long, b string").schema, ["a", "b"], rows_per_file=1)
    assert t.read().collect() == [] and t.optimize() is None
    t.commit(None, t.write_files(t.read(), 0))
    rows = spark.createDataFrame([(None, None), (1, ""), (2, "é")], "a long, b string")
    t.commit(0, t.write_files(rows, 3))
    assert t.read().count() == 3 and t.read(where={"a": (2, 2)}).collect() == [(2, "é")]
