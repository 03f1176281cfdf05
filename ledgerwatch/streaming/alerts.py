"""E2/E4/R4 on a stream: hold episodes and incidents as session windows.

Points are aligned into tumbling windows, windows that violate the condition
pass, and a second windowed aggregate joins them into sessions per series.
Both aggregates are Spark's own, keep partial states only, and give a row out
once the watermark has passed it (append mode), so a restart neither loses nor
repeats one.  Episodes and incidents that are still open are not reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.scalar import sorted_label_entries
from ledgerwatch.operators import alerts, series
from ledgerwatch.streaming.series import event_time

KEYS = ["metric", "series_key"]


def _violating(points: DataFrame, period_seconds: int, aligner: str, comparison: str, threshold: float, watermark: str) -> DataFrame:
    aligned = (event_time(points).withWatermark("ts", watermark)
               .groupBy("metric", sorted_label_entries("labels").alias("series_key"), F.window("ts", f"{int(period_seconds)} seconds").alias("w"))
               .agg(series.aligner_expr(aligner, F.col("value"), period_seconds, False, F.col("ts")).alias("value")))
    return alerts.threshold_flags(aligned, comparison, threshold).filter("violating").select(
        *KEYS, F.window_time("w").alias("at"), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "value")


def stream_hold_episodes(points: DataFrame, period_seconds: int, duration_seconds: int, comparison: str, threshold: float,
                         aligner: str = "ALIGN_SUM", watermark: str = "10 minutes") -> DataFrame:
    """Closed runs of violating windows that lasted ``duration``: the columns of ``alerts.hold_episodes``."""
    period, steps = int(period_seconds), -(-int(duration_seconds) // int(period_seconds))
    # Windows lie on a grid, so one and a half periods join neighbours and nothing else.
    run = F.session_window("at", f"{period * 1500} milliseconds").alias("run")
    runs = _violating(points, period, aligner, comparison, threshold, watermark).groupBy(*KEYS, run).agg(
        F.min("window_start").alias("episode_start"), F.max("window_start").alias("_last_start"), F.max("window_end").alias("episode_end"),
        F.count(F.lit(1)).alias("windows"), F.max("value").alias("peak_value"), F.min("value").alias("low_value"))
    return (runs.withColumn("fired_at", F.timestamp_add("SECOND", F.lit(steps * period), F.col("episode_start")))
            .filter(F.col("fired_at") <= F.col("_last_start"))
            .select(*KEYS, "episode_start", "fired_at", "episode_end", "windows", "peak_value", "low_value"))


def stream_incidents(points: DataFrame, period_seconds: int, auto_close_seconds: int, comparison: str, threshold: float,
                     aligner: str = "ALIGN_SUM", watermark: str = "10 minutes") -> DataFrame:
    """Closed incidents of a condition that fires at once (duration 0): opened_at, resolved_at, windows, peak_value, low_value.

    An incident takes the next violating window while that starts less than
    ``auto_close`` behind the last one's end, as ``alerts.incidents`` does.
    """
    gap_ms = (int(period_seconds) + int(auto_close_seconds)) * 1000 - 500  # starts are whole seconds apart
    incident = F.session_window("at", f"{gap_ms} milliseconds").alias("incident")
    return _violating(points, period_seconds, aligner, comparison, threshold, watermark).groupBy(*KEYS, incident).agg(
        F.min("window_start").alias("opened_at"), F.max("window_end").alias("resolved_at"), F.count(F.lit(1)).alias("windows"),
        F.max("value").alias("peak_value"), F.min("value").alias("low_value")).select(
        *KEYS, "opened_at", "resolved_at", "windows", "peak_value", "low_value")
