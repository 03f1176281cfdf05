"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by Spark's reader, so any store that Spark can read will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    On a cluster the setting must exist; only a ``local`` master (tests) gets a
    scratch folder when it is unset.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: what follows survives lost executors without
    recomputing, and several readers share one computation.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_rows(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string column, one row at a time; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    binary = column.cast(pa.large_binary())
    offsets = np.frombuffer(binary.buffers()[1], dtype=np.int64,
                            count=len(binary) + 1 + binary.offset)[binary.offset:] if len(binary) else []
    data = memoryview(binary.buffers()[2] or b"") if len(binary) else b""
    nulls = binary.is_null().to_pylist() if binary.null_count else None
    for i in range(len(binary)):
        yield b"" if nulls and nulls[i] else bytes(data[offsets[i]:offsets[i + 1]])


#: Bounds of an Arrow batch between the JVM and Python; a single longer row makes a batch of its own.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with small batches: texts are long, and the default of 64 MB a batch is held several times.

    Lowers the session's batch bounds where they are larger.
    """
    conf = df.sparkSession.conf
    for key, bound in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        if not 0 < _number(conf.get(key)) <= bound:
            conf.set(key, str(bound))
    return df.mapInArrow(function, schema)


def _number(value: str) -> int:
    digits = value.rstrip("bBkKmMgG")
    return int(digits) * {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}[value[len(digits):].lower()[:1]]


def ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Places first[k], first[k] + 1, ... (count[k] of them) for every k, in one array."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)
