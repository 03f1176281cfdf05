"""Join helpers: broadcast a side only behind a size check.

``small_side`` marks a join side for broadcast only when the optimizer's size
estimate of that side (plan statistics, the same number Spark compares with
``spark.sql.autoBroadcastJoinThreshold``; no job runs) is within a bound.
Beyond the bound the side is returned unmarked, so the join stays a shuffle
join that AQE may still turn into a broadcast after measuring the real size.
Configuration tables built on the driver with :func:`local_table` are local
relations whose estimate is exact, whatever the session's Arrow setting (they
are built from an Arrow table); dimension scans are estimated from their file sizes.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Largest side the library broadcasts on its own (bytes, plan estimate).
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` in bytes (no job runs); ``None``
    when the session does not expose plan statistics (e.g. Spark Connect)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:  # noqa: BLE001 - no classic JVM handle
        return None


def small_side(df: DataFrame, max_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``broadcast(df)`` when its estimate is at most ``max_bytes``, else ``df``
    (also when no estimate is available)."""
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small driver-built table (configuration rows) as a local relation."""
    struct = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), struct)
