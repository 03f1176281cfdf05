"""E4/E7 on a stream: incidents of holds and of absences as open, renew and close rows.

Points are aligned by Spark's own windowed aggregate, which gives a window out once the
watermark has passed it, so late and shuffled points are settled before they get here and
the windows of a series reach its state in their order, batch by batch.  The state of a
series (``transformWithState``: a handful of numbers, whatever the number of points) holds
its current run or its last window, and its open incident.  An event-time timer wakes a
series that falls silent: an absence fires there, and an incident closes there once no
episode that would renew it can still come.

The rows of a series are those of the batch operators (``alerts.incidents`` over
``alerts.hold_episodes`` or ``alerts.absence_episodes``), however its points are cut into
batches: ``open`` and ``renew`` at the time an episode fires, ``close`` at the end of the
last one.  A gap that lasts until the series reports again keeps its incident open.

Python state lives in RocksDB: the session needs ``STATE_STORE`` (Spark refuses to start the
query without it).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerwatch.functions.scalar import sorted_label_entries
from ledgerwatch.operators import alerts, series
from ledgerwatch.streaming.series import event_time

STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
OUTPUT_SCHEMA = "metric string, series string, event string, at timestamp, opened_at timestamp, last_fired_at timestamp, episodes long"


@dataclass
class Series:
    """State of one series; times in microseconds.

    ``start`` and ``last`` are the first and last window start of the run (hold) or both the
    start of the last window (absence); ``fired`` says whether that run, or the gap behind
    that window, is an episode of the incident.  ``ended`` is the end of the incident's last
    episode, null while it lasts.
    """

    start: int | None = None
    last: int | None = None
    fired: bool = False
    opened: int | None = None
    last_fired: int | None = None
    ended: int | None = None
    episodes: int = 0


STATE_SCHEMA = "start long, last long, fired boolean, opened long, last_fired long, ended long, episodes long"


@dataclass(frozen=True)
class Condition:
    """What makes an episode (``hold`` or ``absence``); lengths in microseconds."""

    kind: str
    period: int
    duration: int
    auto_close: int

    @property
    def settled(self) -> int:
        """Windows that start within ``duration`` end this long behind its begin."""
        return -(-self.duration // self.period) * self.period

    def _fire(self, s: Series, at: int, ended: int | None) -> Iterator[tuple]:
        if s.opened is not None and at >= s.ended + self.auto_close:
            yield self._close(s)
        new = s.opened is None
        s.opened, s.last_fired, s.ended, s.episodes, s.fired = (at if new else s.opened), at, ended, s.episodes + 1, True
        yield ("open" if new else "renew"), at, s.opened, at, s.episodes

    @staticmethod
    def _close(s: Series) -> tuple:
        row = "close", s.ended, s.opened, s.last_fired, s.episodes
        s.opened = s.last_fired = s.ended = None
        s.episodes = 0
        return row

    def advance(self, s: Series, start: int) -> Iterator[tuple]:
        """Take the next window (violating ones of a hold, all of an absence), in order of ``start``."""
        if self.kind == "hold":
            if s.last is None or start != s.last + self.period:
                s.start, s.fired = start, False
            s.last = start
            if s.fired:
                s.ended = start + self.period
            elif start >= s.start + self.settled:
                yield from self._fire(s, s.start + self.settled, start + self.period)
            return
        if s.last is not None:
            gap = s.last + self.period
            if s.fired:  # the gap fired before this window came
                s.ended = start
            elif gap + self.duration <= start:
                yield from self._fire(s, gap + self.duration, start)
        s.start, s.last, s.fired = start, start, False

    def settle(self, s: Series, now: int) -> Iterator[tuple]:
        """What is decided once all windows that end by ``now`` are in."""
        if self.kind == "absence" and s.last is not None and not s.fired and s.last + self.period + self.settled <= now:
            yield from self._fire(s, s.last + self.period + self.duration, None)
        if s.ended is not None and s.ended + self.auto_close + self.period <= now:
            yield self._close(s)
            if self.kind == "hold":
                s.fired = False  # its run is over, or this time would lie ahead
        if self.kind == "hold" and s.opened is None and s.last is not None and s.last + 2 * self.period <= now:
            s.start = s.last = None

    def next_time(self, s: Series) -> int | None:
        """When ``settle`` has something to decide; null if only a window can change the series."""
        times = []
        if s.ended is not None:
            times.append(s.ended + self.auto_close + self.period)
        if self.kind == "absence" and s.last is not None and not s.fired:
            times.append(s.last + self.period + self.settled)
        if self.kind == "hold" and s.opened is None and s.last is not None:
            times.append(s.last + 2 * self.period)
        return min(times, default=None)


class _Incidents(StatefulProcessor):
    def __init__(self, condition: Condition):
        self.condition = condition

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("series", STATE_SCHEMA)

    def _load(self) -> Series:
        found = self.state.get()
        return Series(*found) if found is not None else Series()

    def _save(self, s: Series, now_ms: int) -> None:
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        due = self.condition.next_time(s)
        if due is None and s == Series():
            self.state.clear()
            return
        self.state.update(astuple(s))
        if due is not None:
            self.handle.registerTimer(max(-(-due // 1000), now_ms + 1))

    @staticmethod
    def _frame(key: tuple, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            out = pd.DataFrame(rows, columns=["event", "at", "opened_at", "last_fired_at", "episodes"])
            for c in ("at", "opened_at", "last_fired_at"):
                out[c] = pd.to_datetime(out[c], unit="us")
            out.insert(0, "metric", key[0])
            out.insert(1, "series", key[1])
            yield out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now_ms = timerValues.getCurrentWatermarkInMs()
        s, out = self._load(), []
        for start in sorted(int(x) for frame in rows for x in frame["start_us"]):
            if s.last is not None and start <= s.last:
                continue  # a window comes once; a repeated row changes nothing
            out += self.condition.settle(s, start)  # all windows that end by its start came before it
            out += self.condition.advance(s, start)
        out += self.condition.settle(s, now_ms * 1000)  # windows that end by the watermark came with this batch or before
        self._save(s, now_ms)
        yield from self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now_ms = timerValues.getCurrentWatermarkInMs()
        s = self._load()
        out = list(self.condition.settle(s, now_ms * 1000))
        self._save(s, now_ms)
        yield from self._frame(key, out)

    def close(self) -> None:
        pass


def _incidents(aligned: DataFrame, condition: Condition) -> DataFrame:
    rows = aligned.select("metric", F.to_json(F.map_from_entries("series_key")).alias("series"), "w", F.unix_micros("w.start").alias("start_us"))
    return rows.groupBy("metric", "series").transformWithStateInPandas(_Incidents(condition), OUTPUT_SCHEMA, "append", "eventTime")


def _condition(kind: str, period_seconds: int, duration_seconds: int, auto_close_seconds: int) -> Condition:
    return Condition(kind, *(int(x) * 1_000_000 for x in (period_seconds, duration_seconds, auto_close_seconds)))


def stream_hold_incidents(points: DataFrame, period_seconds: int, duration_seconds: int, auto_close_seconds: int, comparison: str,
                          threshold: float, aligner: str = "ALIGN_SUM", watermark: str = "10 minutes") -> DataFrame:
    """Open, renew and close rows of a threshold that has to be violated for ``duration``."""
    aligned = (event_time(points).withWatermark("ts", watermark)
               .groupBy("metric", sorted_label_entries("labels").alias("series_key"), F.window("ts", f"{int(period_seconds)} seconds").alias("w"))
               .agg(series.aligner_expr(aligner, F.col("value"), period_seconds, False, F.col("ts")).alias("value")))
    violating = alerts.threshold_flags(aligned, comparison, threshold).filter("violating")
    return _incidents(violating, _condition("hold", period_seconds, duration_seconds, auto_close_seconds))


def stream_absence_incidents(points: DataFrame, period_seconds: int, duration_seconds: int, auto_close_seconds: int,
                             watermark: str = "10 minutes") -> DataFrame:
    """Open, renew and close rows of series without data for ``duration``."""
    aligned = (event_time(points).withWatermark("ts", watermark)
               .groupBy("metric", sorted_label_entries("labels").alias("series_key"), F.window("ts", f"{int(period_seconds)} seconds").alias("w"))
               .agg(F.count(F.lit(1)).alias("n")))
    return _incidents(aligned, _condition("absence", period_seconds, duration_seconds, auto_close_seconds))
