"""Stateful absence detection on a stream of metric points.

Points are first folded in the JVM to one row per series and alignment window
(a deduplication whose state the watermark bounds and which spreads a hot series
over its windows), so the Python state function gets at most one row per window
however many points a series sends.

A window's end ``a`` starts a gap when no window of the series starts before
``a + duration`` (the definition of the batch ``alerts.absence_episodes``).  The
state holds the ends that are not decided yet: an end is dropped once a window
close enough behind it is known, and reported once the watermark has passed
every window that could still come before the gap fires.  Late points inside
the watermark are therefore taken into account, and a silent series leaves the
state when its gap is reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT_SCHEMA = "metric string, series string, gap_start timestamp, fired_at timestamp"
STATE_SCHEMA = "ends_us array<long>"


def decide(ends: list[int], watermark_us: int, period_us: int, duration_us: int) -> tuple[list[int], list[int]]:
    """Split window ends into (gap starts, undecided ends)."""
    # A window that starts before the gap fires ends by then at the latest.
    settled_us = -(-duration_us // period_us) * period_us
    gaps, undecided = [], []
    ends = sorted(set(ends))
    for a, b in zip(ends, [*ends[1:], None]):
        if b is not None and b - period_us < a + duration_us:
            continue
        (gaps if a + settled_us <= watermark_us else undecided).append(a)
    return gaps, undecided


def _absence_fn(period_seconds: int, duration_seconds: int):
    period_us, dur_us = int(period_seconds) * 1_000_000, int(duration_seconds) * 1_000_000
    settled_ms = -(-dur_us // period_us) * period_us // 1000

    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ends = list(state.get[0]) if state.exists else []
        if not state.hasTimedOut:
            ends += [int(e) for pdf in pdfs for e in pdf["end_us"]]
        now_ms = state.getCurrentWatermarkMs()
        gaps, undecided = decide(ends, now_ms * 1000, period_us, dur_us)
        if undecided:
            state.update((undecided,))
            state.setTimeoutTimestamp(max(undecided[0] // 1000 + settled_ms, now_ms + 1))
        else:
            state.remove()
        if gaps:
            gap = pd.to_datetime(pd.Series(gaps), unit="us")
            yield pd.DataFrame({"metric": key[0], "series": key[1], "gap_start": gap, "fired_at": gap + pd.Timedelta(microseconds=dur_us)})

    return fn


def stream_absence(points: DataFrame, period_seconds: int, duration_seconds: int,
                   watermark: str = "10 minutes") -> DataFrame:
    """Absence rows (``metric, series, gap_start, fired_at``) from a points stream."""
    from ledgerwatch.streaming.series import event_time
    series = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("labels")))).alias("series")
    windows = (event_time(points).withWatermark("ts", watermark)
               .select("metric", series, F.window("ts", f"{int(period_seconds)} seconds").alias("w"))
               .dropDuplicates(["metric", "series", "w"])
               .select("metric", "series", "w", F.unix_micros(F.col("w.end")).alias("end_us")))
    return windows.groupBy("metric", "series").applyInPandasWithState(
        _absence_fn(period_seconds, duration_seconds), OUTPUT_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.EventTimeTimeout)
