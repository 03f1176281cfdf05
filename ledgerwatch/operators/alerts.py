"""Alert evaluation over aligned series.

Conditions turn aligned rows into *episodes* (one continuous violation) and
episodes into *incidents*.  The per-series windows below (``lag``/``lead``,
running sums) partition by series: after alignment a series holds at most
``time range / period`` rows however large the raw data is, so no group grows
with the input volume.

[design] choices, since the reference leaves them to a managed service:

* E2 hold: consecutive violating windows form a run (a missing or
  non-violating window breaks it).  The condition fires at the first window
  whose start is ``>= run_start + duration``; ``duration = 0`` fires on the
  first violating window.
* E3 absence: a gap starts at the end of the last window with data; the
  condition fires at ``gap_start + duration`` if no data arrived by then.  The
  last gap is closed by ``as_of``; series listed in ``expected`` that never
  reported start their gap at ``since``.
* E4 incidents: episodes of one (policy, series) whose fire time is less than
  ``auto_close`` after the end of the previous episodes merge into one incident.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.functions.scalar import render_template
from ledgerwatch.operators.upsert import _ts_literal

SERIES = ("metric", "series_key")


def _cmp(value: Column, comparison: str | Column, threshold: float | Column) -> Column:
    th = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    if isinstance(comparison, Column):
        return (F.when(comparison == "COMPARISON_GT", value > th)
                 .when(comparison == "COMPARISON_LT", value < th)
                 .when(comparison == "COMPARISON_GE", value >= th)
                 .when(comparison == "COMPARISON_LE", value <= th)
                 .when(comparison == "COMPARISON_EQ", value == th)
                 .when(comparison == "COMPARISON_NE", value != th))
    c = comparison.upper().removeprefix("COMPARISON_")
    return {"GT": value > th, "LT": value < th, "GE": value >= th, "LE": value <= th,
            "EQ": value == th, "NE": value != th}[c]


def threshold_flags(aligned: DataFrame, comparison: str | Column, threshold: float | Column) -> DataFrame:
    """Mark each aligned value that violates ``value <comparison> threshold``."""
    return aligned.withColumn("violating", F.coalesce(_cmp(F.col("value"), comparison, threshold), F.lit(False)))


def _dur(x: int | Column) -> Column:
    return x if isinstance(x, Column) else F.lit(int(x))


def hold_episodes(flagged: DataFrame, period_seconds: int | Column, duration_seconds: int | Column,
                  keys: Sequence[str] = SERIES) -> DataFrame:
    """Runs of consecutive violating windows that last at least ``duration``.

    Output per fired run: ``keys, episode_start, fired_at, episode_end,
    windows, peak_value`` (``peak_value`` = max for ``>`` conditions; use the
    sign of the threshold for ``<`` policies downstream).
    """
    keys = list(keys)
    period = _dur(period_seconds)
    v = flagged.filter("violating")
    w = Window.partitionBy(*keys).orderBy("window_start")
    prev_start = F.lag("window_start").over(w)
    new_run = F.when(prev_start.isNull(), 1).when(
        F.col("window_start") != F.timestamp_add("SECOND", period, prev_start), 1).otherwise(0)
    runs = (v.withColumn("_new", new_run)
             .withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    agg = runs.groupBy(*keys, "_run").agg(
        F.min("window_start").alias("episode_start"),
        F.max("window_start").alias("_last_start"),
        F.max("window_end").alias("episode_end"),
        F.count(F.lit(1)).alias("windows"),
        F.max("value").alias("peak_value"),
        F.min("value").alias("low_value"))
    steps = F.ceil(_dur(duration_seconds).cast("double") / period.cast("double")).cast("int")
    fired = F.timestamp_add("SECOND", steps * period, F.col("episode_start"))
    return (agg.withColumn("fired_at", fired)
               .filter(F.col("fired_at") <= F.col("_last_start"))
               .select(*keys, "episode_start", "fired_at", "episode_end", "windows", "peak_value", "low_value"))


def condition_sequence(flagged: DataFrame, period_seconds: int | Column,
                       keys: Sequence[str] = SERIES) -> DataFrame:
    """Per-series window columns shared by hold and absence evaluation.

    Adds ``_run`` (id of the run of consecutive violating windows; a missing
    or non-violating window ends a run) and ``_next`` (start of the series'
    next window with data).  One exchange and sort per series key.
    """
    keys = list(keys)
    period = _dur(period_seconds)
    w = Window.partitionBy(*keys).orderBy("window_start")
    prev_start = F.lag("window_start").over(w)
    prev_viol = F.lag("violating").over(w)
    adjacent = F.coalesce(F.col("window_start") == F.timestamp_add("SECOND", period, prev_start), F.lit(False))
    new_run = F.when(F.col("violating") & ~(adjacent & F.coalesce(prev_viol, F.lit(False))), 1).otherwise(0)
    return (flagged.withColumn("_new", new_run)
                   .withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                   .withColumn("_next", F.lead("window_start").over(w)))


def hold_from_sequence(seq: DataFrame, period_seconds: int | Column, duration_seconds: int | Column,
                       keys: Sequence[str] = SERIES) -> DataFrame:
    """E2 on a :func:`condition_sequence` output (same result as :func:`hold_episodes`)."""
    keys = list(keys)
    period = _dur(period_seconds)
    agg = seq.filter("violating").groupBy(*keys, "_run").agg(
        F.min("window_start").alias("episode_start"),
        F.max("window_start").alias("_last_start"),
        F.max("window_end").alias("episode_end"),
        F.count(F.lit(1)).alias("windows"),
        F.max("value").alias("peak_value"),
        F.min("value").alias("low_value"))
    steps = F.ceil(_dur(duration_seconds).cast("double") / period.cast("double")).cast("int")
    fired = F.timestamp_add("SECOND", steps * period, F.col("episode_start"))
    return (agg.withColumn("fired_at", fired)
               .filter(F.col("fired_at") <= F.col("_last_start"))
               .select(*keys, "episode_start", "fired_at", "episode_end", "windows", "peak_value", "low_value"))


def absence_from_sequence(seq: DataFrame, duration_seconds: int | Column, as_of,
                          expected: DataFrame | None = None, since=None,
                          keys: Sequence[str] = SERIES) -> DataFrame:
    """E3 on a :func:`condition_sequence` output (same result as :func:`absence_episodes`)."""
    keys = list(keys)
    gaps = seq.select(*keys, F.col("window_end").alias("episode_start"), F.col("_next").alias("episode_end"))
    return _close_gaps(gaps, seq, duration_seconds, as_of, expected, since, keys)


def _close_gaps(gaps: DataFrame, seen_from: DataFrame, duration_seconds, as_of, expected, since,
                keys: list[str]) -> DataFrame:
    now = _ts_literal(as_of)
    if expected is not None:
        seen = seen_from.select(*keys).distinct()
        silent = expected.select(*keys).join(seen, on=keys, how="left_anti")
        gaps = gaps.unionByName(silent.select(*keys, _ts_literal(since).alias("episode_start"),
                                              F.lit(None).cast("timestamp_ntz").alias("episode_end")))
    fired = F.timestamp_add("SECOND", _dur(duration_seconds), F.col("episode_start"))
    limit = F.coalesce(F.col("episode_end"), now)
    return (gaps.withColumn("fired_at", fired)
                .filter(F.col("fired_at") <= limit)
                .select(*keys, "episode_start", "fired_at", "episode_end"))


def absence_episodes(aligned: DataFrame, duration_seconds: int | Column, as_of,
                     expected: DataFrame | None = None, since=None,
                     keys: Sequence[str] = SERIES) -> DataFrame:
    """Gaps without data of at least ``duration`` per series.

    Output: ``keys, episode_start (gap start), fired_at, episode_end`` where
    ``episode_end`` is the start of the next data window, or NULL while the
    gap is still open at ``as_of``.  ``expected`` lists series (``keys``
    columns) that must report; those with no data at all get a gap from ``since``.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("window_start")
    gaps = (aligned.select(*keys, "window_start", "window_end")
            .withColumn("_next", F.lead("window_start").over(w))
            .select(*keys, F.col("window_end").alias("episode_start"), F.col("_next").alias("episode_end")))
    return _close_gaps(gaps, aligned, duration_seconds, as_of, expected, since, keys)


def incidents(episodes: DataFrame, auto_close_seconds: int | Column, as_of=None,
              keys: Sequence[str] = SERIES) -> DataFrame:
    """Merge episodes closer than ``auto_close`` into incidents.

    Output: ``keys, incident_seq, opened_at, last_fired_at, resolved_at,
    episodes``; ``resolved_at`` is NULL while the last episode is still open.
    """
    keys = list(keys)
    far = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    end = F.coalesce(F.col("episode_end"), far)
    w = Window.partitionBy(*keys).orderBy("fired_at", "episode_start")
    prev_end = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(prev_end.isNull(), 1).when(
        F.col("fired_at") >= F.timestamp_add("SECOND", _dur(auto_close_seconds), prev_end), 1).otherwise(0)
    seq = (episodes.withColumn("_new", new)
                   .withColumn("incident_seq", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    out = seq.groupBy(*keys, "incident_seq").agg(
        F.min("fired_at").alias("opened_at"),
        F.max("fired_at").alias("last_fired_at"),
        F.max(end).alias("_end"),
        F.count(F.lit(1)).alias("episodes"))
    return out.select(*keys, "incident_seq", "opened_at", "last_fired_at",
                      F.when(F.col("_end") == far, F.lit(None).cast("timestamp_ntz"))
                       .otherwise(F.col("_end")).alias("resolved_at"),
                      "episodes")


def notification_rows(incident_rows: DataFrame, policy_name: str | Column, severity: str | Column,
                      template: str, label_keys: Sequence[str] = ()) -> DataFrame:
    """One payload row per incident with the rendered documentation text.

    ``${metric.labels.<key>}`` placeholders are filled from the series labels.
    """
    labels = F.map_from_entries("series_key")
    variables = {f"metric.labels.{k}": labels[k] for k in label_keys}
    name = policy_name if isinstance(policy_name, Column) else F.lit(policy_name)
    sev = severity if isinstance(severity, Column) else F.lit(severity)
    return incident_rows.select(
        "*", name.alias("policy"), sev.alias("severity"),
        render_template(template, variables).alias("message"))
