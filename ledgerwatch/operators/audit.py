"""Cost audits over job and storage metadata (A9, A10) and the pair count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.scalar import safe_divide
from ledgerwatch.operators.upsert import _ts_literal

SLOT_TIME_THRESHOLD = 86400          # slot-seconds (one slot-day)
GIB = 1024 ** 3
# List storage prices per GiB-month, logical and physical.
LOGICAL_PRICE_PER_GIB = 0.02
PHYSICAL_PRICE_PER_GIB = 0.04


def latest_time(df: DataFrame, col: str) -> Column:
    """``max(col)`` of ``df`` as a scalar-subquery Column (no driver round trip)."""
    return df.select(F.max(col)).scalar()


def slot_time_audit(jobs: DataFrame, as_of=None, threshold: float = SLOT_TIME_THRESHOLD,
                    window_hours: int = 24) -> DataFrame:
    """Finished jobs of the last ``window_hours`` above ``threshold`` slot-seconds.

    ``as_of`` replaces ``CURRENT_TIMESTAMP()``; when omitted the newest
    ``creation_time`` is used via a scalar subquery.  The filter is on scan
    columns only, so it is pushed to the parquet reader.
    """
    now = latest_time(jobs, "creation_time") if as_of is None else _ts_literal(as_of)
    slot_s = F.col("total_slot_ms") / F.lit(1000)
    return (jobs
            .filter((F.col("creation_time") >= F.timestamp_add("HOUR", F.lit(-window_hours), now))
                    & (F.col("state") == "DONE") & (slot_s > F.lit(threshold)))
            .select("job_id", "project_id", "user_email", "job_type", "state", "creation_time",
                    "end_time", slot_s.alias("total_slot_seconds"), "total_bytes_processed",
                    "total_bytes_billed", "query")
            .orderBy(F.col("total_slot_seconds").desc(), "job_id"))


def storage_comparison(storage: DataFrame, snapshot_time=None) -> DataFrame:
    """A10: per dataset table count, byte sums, compression ratio, monthly cost
    under both billing models and the cheaper one (strict ``<``; ties LOGICAL)."""
    logical = F.sum("total_logical_bytes")
    physical = F.sum("total_physical_bytes")
    cost_l = logical / F.lit(float(GIB)) * F.lit(LOGICAL_PRICE_PER_GIB)
    cost_p = physical / F.lit(float(GIB)) * F.lit(PHYSICAL_PRICE_PER_GIB)
    snap = F.current_timestamp().cast("timestamp_ntz") if snapshot_time is None else _ts_literal(snapshot_time)
    return (storage.groupBy(F.col("table_schema").alias("dataset_id"))
            .agg(F.count(F.lit(1)).alias("table_count"),
                 logical.alias("total_logical_bytes"),
                 physical.alias("total_physical_bytes"),
                 safe_divide(physical, logical).alias("compression_ratio"),
                 cost_l.alias("est_monthly_cost_logical"),
                 cost_p.alias("est_monthly_cost_physical"),
                 F.when(cost_p < cost_l, F.lit("PHYSICAL_CHEAPER")).otherwise(F.lit("LOGICAL_CHEAPER"))
                 .alias("recommended_billing_model"))
            .select(snap.alias("snapshot_time"), "*")
            .orderBy(F.col("total_logical_bytes").desc(), "dataset_id"))


def count_pairs(df: DataFrame, key: str) -> DataFrame:
    """``SELECT COUNT(*) FROM df a CROSS JOIN df b WHERE a.key != b.key``.

    Computed without forming pairs: with ``n`` non-NULL keys and ``n_k`` rows
    per key value, the count is ``n^2 - sum(n_k^2)`` (a NULL key never compares
    unequal).  One partial aggregate by key, then one global sum: no cross join.
    """
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).cast("decimal(19,0)").alias("n_k"))
    n, squares = F.coalesce(F.sum("n_k"), F.lit(0)), F.coalesce(F.sum(F.col("n_k") * F.col("n_k")), F.lit(0))
    return per_key.agg(n.cast("decimal(19,0)").alias("n"), squares.cast("decimal(38,0)").alias("s")).select(
        (F.col("n") * F.col("n") - F.col("s")).cast("decimal(38,0)").alias("pair_count"))
