"""Streaming alignment with a watermark.

The same ``series.align`` plan runs on a stream: ``window(ts, period)`` is a
tumbling window, the watermark bounds state and lets ``append`` mode emit a
window once it can no longer change.  Percentile aligners use
``percentile_approx`` (exact percentiles are not supported on streams).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerwatch.operators import series


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need ``timestamp``; UTC wall-clock ``timestamp_ntz`` is cast
    (the session zone is UTC, so the instant is unchanged)."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return df.withColumn(col, F.col(col).cast("timestamp"))
    return df


def stream_align(points: DataFrame, period_seconds: int, aligner: str = "ALIGN_SUM",
                 watermark: str = "10 minutes") -> DataFrame:
    return series.align(event_time(points).withWatermark("ts", watermark), period_seconds, aligner, exact=False)


def start_to_table(aligned: DataFrame, path: str, checkpoint_location: str,
                   processing_time: str = "1 minute", available_now: bool = False) -> StreamingQuery:
    """Append finished windows to a parquet table (exactly-once file sink)."""
    w = (aligned.drop("series_key").writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
