"""The lag of a running feed as metric points.

``observed`` measures event-to-ingest lag on the rows of every micro-batch while
they pass (``observe``: no extra pass over the data); ``LagListener`` turns each
progress report into one point of the stream latency metric, which the
``stream_lag`` policy reads.  A micro-batch without rows gives no point.  A batch
that runs again after a failure may give a second point, which changes neither
a maximum nor whether the threshold is violated.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ledgerwatch.operators.joins import local_table
from ledgerwatch.plans import metrics as M

_POINT = "metric string, resource_type string, resource_labels map<string,string>, labels map<string,string>, ts timestamp_ntz, value double"


def observed(feed: DataFrame, name: str, event_time: str = "updated_at", now: Column | None = None) -> DataFrame:
    """``feed`` with its rows, largest lag in seconds and newest event observed under ``name``.

    Event times without a zone are UTC; rows without one have no lag; an event ahead of the clock lags by zero.
    """
    at = F.unix_micros(F.col(event_time).cast("timestamp"))
    lag = F.greatest((F.unix_micros(now if now is not None else F.current_timestamp()) - at) / 1e6, F.lit(0.0))
    return feed.observe(name, F.count(F.lit(1)).alias("rows"), F.max(F.when(at.isNotNull(), lag)).alias("lag_s"), F.max(at).alias("newest_us"))


class LagListener(StreamingQueryListener):
    """Appends a point to the Parquet table ``path`` for every progress report that holds the observation ``name``."""

    def __init__(self, spark: SparkSession, name: str, path: str, stream_id: str, resource_labels: dict[str, str] | None = None,
                 clock: Callable[[str], datetime] | None = None):
        self.spark, self.name, self.path, self.stream_id = spark, name, path, stream_id
        self.resource_labels, self.clock = resource_labels or {}, clock or _utc

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is None or found["lag_s"] is None:
            return
        row = (M.STREAM_LATENCY, M.STREAM, self.resource_labels, {"stream_id": self.stream_id}, self.clock(event.progress.timestamp), float(found["lag_s"]))
        local_table(self.spark, [row], _POINT).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        pass


def _utc(timestamp: str) -> datetime:
    return datetime.fromisoformat(timestamp).astimezone(timezone.utc).replace(tzinfo=None)
