"""T10 on a stream: the series with the largest totals, in bounded state.

Aligned windows are dealt by series into ``buckets``; a bucket keeps at most
``capacity`` counters (space-saving: a new series takes over the smallest
counter and carries its value as a possible error).  A series lies in one bucket
for good, so its numbers hold as they are:

* ``total - error <= true total <= total``;
* a series without a counter has at most ``floor``, which is at most
  ``weight / capacity`` (``weight``: all values of the bucket).

Every batch that brings a bucket windows reports its counters with a rising
``version``; ``top`` picks the winners from the newest reports.  Nulls and NaN
count as zero; negative values have no bounds here and fail the query.

Python state lives in RocksDB: the session needs ``incidents.STATE_STORE``.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerwatch.functions.scalar import sorted_label_entries
from ledgerwatch.operators import series
from ledgerwatch.streaming.series import event_time

OUTPUT_SCHEMA = ("metric string, bucket int, version long, as_of timestamp, series string, total double, error double, "
                 "floor double, weight double")
_STATE = "names array<string>, totals array<double>, errors array<double>, weight double, version long, as_of long"


class Counters:
    """At most ``capacity`` counters: name -> [total, error]."""

    def __init__(self, capacity: int, held: dict[str, list[float]] | None = None, weight: float = 0.0):
        self.capacity, self.held, self.weight = capacity, held or {}, weight
        self.heap = [(c[0], name) for name, c in self.held.items()]
        heapq.heapify(self.heap)

    def add(self, name: str, value: float) -> None:
        if value < 0:
            raise ValueError(f"negative value {value} of {name}: totals have no bounds")
        self.weight += value
        counter = self.held.get(name)
        if counter is not None:
            counter[0] += value  # its heap entry is brought up to date when it comes up
        elif value == 0:
            return
        else:
            least = 0.0
            if len(self.held) >= self.capacity:
                least, smallest = self._least()
                heapq.heappop(self.heap)
                del self.held[smallest]
            self.held[name] = [least + value, least]
            heapq.heappush(self.heap, (least + value, name))

    def _least(self) -> tuple[float, str]:
        while True:
            total, name = self.heap[0]
            now = self.held[name][0]
            if now == total:
                return total, name
            heapq.heapreplace(self.heap, (now, name))

    def floor(self) -> float:
        return self._least()[0] if len(self.held) >= self.capacity else 0.0


class _Top(StatefulProcessor):
    def __init__(self, capacity: int):
        self.capacity = capacity

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("counters", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = self.state.get()
        names, totals, errors, weight, version, as_of = found if found is not None else ([], [], [], 0.0, 0, 0)
        counters = Counters(self.capacity, {n: [t, e] for n, t, e in zip(names, totals, errors)}, weight)
        sums: dict[str, float] = {}
        for frame in rows:
            for name, value, end in zip(frame["series"], frame["value"], frame["end_us"]):
                value = 0.0 if value is None or math.isnan(value) else float(value)
                if value < 0:
                    raise ValueError(f"negative value {value} of {name}: totals have no bounds")
                sums[name] = sums.get(name, 0.0) + value
                as_of = max(as_of, int(end))
        for name in sorted(sums):  # a batch that runs again ends in the same state
            counters.add(name, sums[name])
        held = counters.held
        names = list(held)
        self.state.update((names, [held[n][0] for n in names], [held[n][1] for n in names], counters.weight, version + 1, as_of))
        if names:
            yield pd.DataFrame({
                "metric": key[0], "bucket": key[1], "version": version + 1, "as_of": pd.to_datetime(as_of, unit="us"), "series": names,
                "total": [held[n][0] for n in names], "error": [held[n][1] for n in names], "floor": counters.floor(), "weight": counters.weight})

    def close(self) -> None:
        pass


def stream_top(points: DataFrame, period_seconds: int, aligner: str = "ALIGN_SUM", capacity: int = 1000, buckets: int = 64,
               watermark: str = "10 minutes") -> DataFrame:
    """Reports of the counters of every (metric, bucket); append mode, one report per batch with new windows."""
    aligned = (event_time(points).withWatermark("ts", watermark)
               .groupBy("metric", sorted_label_entries("labels").alias("series_key"), F.window("ts", f"{int(period_seconds)} seconds").alias("w"))
               .agg(series.aligner_expr(aligner, F.col("value"), period_seconds, False, F.col("ts")).cast("double").alias("value")))
    name = F.to_json(F.map_from_entries("series_key"))
    rows = aligned.select("metric", name.alias("series"), "w", F.unix_micros("w.end").alias("end_us"), "value").withColumn(
        "bucket", F.pmod(F.xxhash64("metric", "series"), F.lit(int(buckets))).cast("int"))
    return rows.groupBy("metric", "bucket").transformWithStateInPandas(_Top(int(capacity)), OUTPUT_SCHEMA, "append", "eventTime")


def newest(reports: DataFrame) -> DataFrame:
    """The counters of the last report of every bucket."""
    last = reports.groupBy("metric", "bucket").agg(F.max("version").alias("version"))
    return reports.join(last, ["metric", "bucket", "version"])


def top(reports: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest totals; ``certain`` where no other series can be among them in its place.

    The limit is the feature, as in ``series.top_series``; ties go to the smaller key.
    """
    now = newest(reports)
    floor = now.agg(F.max("floor").alias("most_unseen"))
    first = now.orderBy(F.col("total").desc(), "metric", "series").limit(n + 1)
    order = Window.orderBy(F.col("total").desc(), "metric", "series")  # n + 1 rows
    ranked = first.withColumn("rank", F.row_number().over(order))
    rival = ranked.agg(F.max(F.when(F.col("rank") > n, F.col("total"))).alias("rival"))
    return (ranked.filter(F.col("rank") <= n).join(F.broadcast(floor)).join(F.broadcast(rival))  # one row each
            .select("rank", "metric", "series", "total", "error",
                    (F.col("total") - F.col("error") >= F.greatest("most_unseen", F.coalesce("rival", F.lit(0.0)))).alias("certain")))
