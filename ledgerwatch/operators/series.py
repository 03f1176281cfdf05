"""Time-series alignment and reduction.

Points are long rows ``metric, labels map<string,string>, ts, value``.  A series
is ``(metric, labels)``; since a map cannot be a grouping key, the series key is
the label entries sorted by key (``series_key``), and the map is rebuilt from it.

* :func:`align` = one ``groupBy(metric, series_key, window(ts, period))`` with a
  per-series aligner (partial aggregation; ``window`` is half-open
  ``[start, end)`` on the epoch grid and is the same call in streaming).
* :func:`reduce` = a second ``groupBy`` over the aligned rows keeping only the
  ``group_by`` labels (cross-series reducer).

Aligned data is bounded by (series x time / period), not by raw volume, which
is what makes the later per-series windows (hold, absence) safe at scale.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.functions.scalar import bucket_start, sorted_label_entries
from ledgerwatch.operators.joins import small_side

PERCENTILE_ACCURACY = 10000


def _percentile(q: float, exact: bool) -> callable:
    if exact:
        return lambda v: F.percentile(v, F.lit(q))
    return lambda v: F.percentile_approx(v, F.lit(q), F.lit(PERCENTILE_ACCURACY)).cast("double")


def aligner_expr(aligner: str, value: Column, period_seconds: int | Column, exact: bool = True,
                 ts: Column | None = None) -> Column:
    """Aggregate expression of a per-series aligner."""
    a = aligner.upper().removeprefix("ALIGN_")
    period = period_seconds if isinstance(period_seconds, Column) else F.lit(float(period_seconds))
    if a in ("SUM", "DELTA"):
        return F.sum(value)
    if a == "RATE":
        return F.sum(value) / period
    if a == "MEAN":
        return F.avg(value)
    if a == "MAX":
        return F.max(value)
    if a == "MIN":
        return F.min(value)
    if a == "COUNT":
        return F.count(value).cast("double")
    if a == "FRACTION_TRUE":
        return F.avg((value != F.lit(0)).cast("double"))
    if a == "NEXT_OLDER":
        return F.max_by(value, ts)
    if a.startswith("PERCENTILE_"):
        return _percentile(int(a.split("_")[1]) / 100.0, exact)(value)
    raise ValueError(f"unknown aligner {aligner}")


def reducer_expr(reducer: str, value: Column, exact: bool = True) -> Column:
    r = reducer.upper().removeprefix("REDUCE_")
    if r == "SUM":
        return F.sum(value)
    if r == "MAX":
        return F.max(value)
    if r == "MIN":
        return F.min(value)
    if r == "MEAN":
        return F.avg(value)
    if r == "COUNT":
        return F.count(value).cast("double")
    if r == "COUNT_TRUE":
        return F.sum((value != F.lit(0)).cast("double"))
    if r.startswith("PERCENTILE_"):
        return _percentile(int(r.split("_")[1]) / 100.0, exact)(value)
    raise ValueError(f"unknown reducer {reducer}")


def align(points: DataFrame, period_seconds: int, aligner: str = "SUM", exact: bool = True,
          streaming_window: bool = True) -> DataFrame:
    """Per-series alignment into ``[start, start+period)`` windows.

    Output: ``metric, series_key, labels, window_start, window_end, value,
    point_count``.  ``exact=False`` swaps exact percentiles for
    ``percentile_approx`` (bounded memory per group, mergeable; required in
    streaming).  Exact percentiles count equal values first
    (:func:`_exact_percentile`), so no group's values lie in one buffer.
    """
    if exact and aligner.upper().removeprefix("ALIGN_").startswith("PERCENTILE_"):
        return _exact_percentile(points, period_seconds, int(aligner.split("_")[-1]) / 100.0)
    if streaming_window:
        w = F.window("ts", f"{int(period_seconds)} seconds")
        grouped = points.groupBy("metric", sorted_label_entries("labels").alias("series_key"), w.alias("w"))
    else:
        grouped = points.groupBy("metric", sorted_label_entries("labels").alias("series_key"),
                                 F.struct(bucket_start("ts", period_seconds).alias("start")).alias("w"))
    agg = grouped.agg(aligner_expr(aligner, F.col("value"), period_seconds, exact, F.col("ts")).alias("value"),
                      F.count(F.lit(1)).alias("point_count"))
    start = F.col("w.start")
    return agg.select(
        "metric", "series_key", F.map_from_entries("series_key").alias("labels"),
        start.alias("window_start"),
        F.timestamp_add("SECOND", F.lit(int(period_seconds)), start).alias("window_end"),
        F.col("value").cast("double").alias("value"), "point_count")


def _exact_percentile(points: DataFrame, period_seconds: int, q: float) -> DataFrame:
    """Exact percentile (interpolated between ranks) of every series and window.

    Equal values of a window are counted by a partial and a final aggregate that
    spreads a hot window over all tasks; the ranks then come from a running sum
    over its distinct values, which sorts with spill and holds no buffer.  Null
    values count as points but have no rank; a window of nulls has value NULL.
    """
    group = ["metric", "series_key", "window_start"]
    counted = (points.groupBy("metric", sorted_label_entries("labels").alias("series_key"),
                              bucket_start("ts", period_seconds).alias("window_start"), "value")
               .agg(F.count(F.lit(1)).alias("n")))
    known = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
    whole = Window.partitionBy(*group)
    running = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.select("*", F.sum(known).over(running).alias("up_to"),
                            (F.lit(q) * (F.sum(known).over(whole) - 1)).alias("at"))
    # Ranks count from 0: a value holds the ranks up_to - n to up_to - 1.
    holds = lambda rank: F.col("value").isNotNull() & (rank >= F.col("up_to") - F.col("n")) & (rank < F.col("up_to"))
    low, high = F.floor("at"), F.ceil("at")
    found = ranked.groupBy(*group).agg(
        F.max(F.when(holds(low), F.col("value"))).alias("low"), F.max(F.when(holds(high), F.col("value"))).alias("high"),
        F.max(F.col("at") - low).alias("part"), F.sum("n").alias("point_count"))
    value = F.col("low") * (1 - F.col("part")) + F.col("high") * F.col("part")
    return found.select(
        "metric", "series_key", F.map_from_entries("series_key").alias("labels"), "window_start",
        F.timestamp_add("SECOND", F.lit(int(period_seconds)), F.col("window_start")).alias("window_end"),
        value.cast("double").alias("value"), "point_count")


def keep_labels(series_key: Column, group_by: Sequence[str]) -> Column:
    keys = F.array(*[F.lit(k) for k in group_by]) if group_by else F.array().cast("array<string>")
    return F.filter(series_key, lambda e: F.array_contains(keys, e["key"]))


def reduce(aligned: DataFrame, reducer: str = "SUM", group_by: Sequence[str] = (),
           exact: bool = True) -> DataFrame:
    """Cross-series reduction per window, keeping only ``group_by`` labels.

    ``group_by=()`` folds all series of a metric into one (T11)."""
    red = keep_labels(F.col("series_key"), list(group_by)).alias("series_key")
    return (aligned.groupBy("metric", red, "window_start", "window_end")
            .agg(reducer_expr(reducer, F.col("value"), exact).cast("double").alias("value"),
                 F.count(F.lit(1)).alias("series_count"))
            .select("metric", "series_key", F.map_from_entries("series_key").alias("labels"),
                    "window_start", "window_end", "value", "series_count"))


def top_series(df: DataFrame, n: int = 10, total: str = "sum") -> DataFrame:
    """The ``n`` series with the largest total over all windows.

    The limit is the feature (a ``top 10`` panel); ties go to the smaller key.
    """
    agg = F.sum("value") if total == "sum" else F.max("value")
    return (df.groupBy("metric", "series_key")
            .agg(agg.alias("total"), F.count(F.lit(1)).alias("windows"))
            .select("metric", "series_key", F.map_from_entries("series_key").alias("labels"),
                    "total", "windows")
            .orderBy(F.col("total").desc(), "metric", "series_key").limit(n))


def scorecard(df: DataFrame, direction: str = "BELOW", yellow: float | None = None,
              red: float | None = None) -> DataFrame:
    """Latest value per series and its colour against the thresholds.

    ``direction="BELOW"`` colours values under the threshold, ``"ABOVE"`` over it.
    """
    latest = (df.groupBy("metric", "series_key")
              .agg(F.max_by("value", "window_start").alias("value"),
                   F.max("window_start").alias("window_start")))
    below = direction.upper() == "BELOW"

    def breach(th):
        if th is None:
            return F.lit(False)
        return (F.col("value") < F.lit(th)) if below else (F.col("value") > F.lit(th))

    colour = F.when(breach(red), F.lit("red")).when(breach(yellow), F.lit("yellow")).otherwise(F.lit("green"))
    return latest.select("metric", "series_key", F.map_from_entries("series_key").alias("labels"),
                         "window_start", "value", colour.alias("colour"))


def label(col_name: str, key: str) -> Column:
    """A label value as a column (``labels[key]``)."""
    return F.col(col_name)[key].alias(key)


# --------------------------------------------------------------------------- many specs, one pass

SPEC_SCHEMA = ("spec_id string, signal string, resource_filter string, resource_label_filter map<string,string>, label_filter map<string,string>, aligner string, "
               "period_s int, reducer string, group_by array<string>")
_PCTS = [0.05, 0.5, 0.95, 0.99]


#: Names a spec may use; others are refused when the spec table is built.
SPEC_ALIGNERS = frozenset(["ALIGN_SUM", "ALIGN_DELTA", "ALIGN_RATE", "ALIGN_MEAN", "ALIGN_MAX", "ALIGN_MIN", "ALIGN_COUNT",
                           "ALIGN_FRACTION_TRUE", "ALIGN_NEXT_OLDER", *(f"ALIGN_PERCENTILE_{int(p * 100):02d}" for p in _PCTS)])
SPEC_REDUCERS = frozenset(["NONE", "REDUCE_SUM", "REDUCE_MAX", "REDUCE_MIN", "REDUCE_MEAN", "REDUCE_COUNT", "REDUCE_COUNT_TRUE"])
SPEC_COMPARISONS = frozenset(f"COMPARISON_{c}" for c in ("GT", "GE", "LT", "LE", "EQ", "NE"))


def check_spec(spec_id: str, aligner: str, reducer: str, comparison: str | None = None) -> None:
    """Refuse a spec whose aligner, reducer or comparison is unknown."""
    for name, known in ((aligner, SPEC_ALIGNERS), (reducer, SPEC_REDUCERS), (comparison, SPEC_COMPARISONS | {None})):
        if name not in known:
            raise ValueError(f"{spec_id}: unknown {name!r}")


def _align_specs(j: DataFrame, exact: bool, with_pct: bool, aligners: frozenset) -> DataFrame:
    """Aligned series of specs: the partial states that ``aligners`` read, and no others."""
    aligner = F.col("aligner")
    keys = ["spec_id", "aligner", "period_s", "reducer", "group_by"]
    states = {"_sum": (F.sum("value"), ("SUM", "DELTA", "RATE")), "_mean": (F.avg("value"), ("MEAN",)), "_max": (F.max("value"), ("MAX",)),
              "_min": (F.min("value"), ("MIN",)), "_n": (F.count("value"), ("COUNT",)),
              "_frac": (F.avg((F.col("value") != 0).cast("double")), ("FRACTION_TRUE",)), "_last": (F.max_by("value", "ts"), ("NEXT_OLDER",))}
    aggs = [e.alias(k) for k, (e, names) in states.items() if not aligners.isdisjoint(f"ALIGN_{n}" for n in names)]
    if with_pct:
        pcts = F.array(*[F.lit(p) for p in _PCTS])
        held = F.when(aligner.startswith("ALIGN_PERCENTILE_"), F.col("value"))  # other specs keep an empty buffer
        aggs.append((F.percentile(held, pcts) if exact else
                     F.percentile_approx(held, pcts, F.lit(PERCENTILE_ACCURACY))).alias("_pct"))
    al = j.groupBy(*keys, "series_key", bucket_start("ts", F.col("period_s")).alias("window_start")).agg(*aggs or [F.count(F.lit(1)).alias("_any")])
    values = {"ALIGN_SUM": F.col("_sum"), "ALIGN_DELTA": F.col("_sum"), "ALIGN_RATE": F.col("_sum") / F.col("period_s"), "ALIGN_MEAN": F.col("_mean"),
              "ALIGN_MAX": F.col("_max"), "ALIGN_MIN": F.col("_min"), "ALIGN_COUNT": F.col("_n").cast("double"),
              "ALIGN_FRACTION_TRUE": F.col("_frac"), "ALIGN_NEXT_OLDER": F.col("_last")}
    value = F.when(F.lit(False), F.lit(None).cast("double"))
    for name, column in values.items():
        if name in aligners:
            value = value.when(aligner == name, column)
    if with_pct:
        for i, p in enumerate(_PCTS):
            value = value.when(aligner == f"ALIGN_PERCENTILE_{int(p * 100):02d}", F.col("_pct")[i])
    return al.select(*keys, "series_key", "window_start", value.cast("double").alias("value"))


def align_reduce_specs(points: DataFrame, specs: DataFrame, exact: bool = True, percentiles: bool = True,
                       aligners: frozenset = SPEC_ALIGNERS) -> DataFrame:
    """Evaluate many (signal, resource, filter, aligner, period, reducer, group_by)
    specs over ``points``.

    A spec may name a resource type and resource labels (an environment); points
    that do not say where they come from meet only specs that do not ask.  A
    series is known by its metric labels: a spec that admits several resources
    takes points of equal labels as one series.

    ``specs`` is configuration (one row per policy or panel, tens of rows), so
    it is broadcast behind a size check (``joins.small_side``); each point
    meets only the specs of its metric.  One hash
    aggregate computes every plain aligner's partial state and the spec's
    aligner picks its value; a second aggregate applies the cross-series
    reducer (``reducer='NONE'`` keeps each series).

    All specs are aligned in one pass, so every source of the points is read
    once.  Percentile specs fill a buffer beside the plain partial states, that
    of ``percentile_approx`` unless ``exact``; ``percentiles=False`` leaves the
    buffer out when no spec needs it (and the aggregate is a hash aggregate).
    ``aligners`` names those that the specs use; the states of others are not kept.
    """
    s = small_side(specs.withColumnRenamed("signal", "_signal"))
    empty_map = F.create_map().cast("map<string,string>")

    for name, kind in (("resource_type", "string"), ("resource_labels", "map<string,string>")):
        if name not in points.columns:
            points = points.withColumn(name, F.lit(None).cast(kind))

    def carries(labels, wanted):
        return F.forall(F.map_entries(F.coalesce(wanted, empty_map)),
                        lambda e: F.coalesce(F.col(labels)[e["key"]] == e["value"], F.lit(False)))

    # The series key is made once per point, not once per point and spec.
    keyed = points.withColumn("series_key", sorted_label_entries("labels"))
    j = keyed.join(s, keyed.metric == F.col("_signal"))
    of_type = F.col("resource_filter").isNull() | F.coalesce(F.col("resource_type") == F.col("resource_filter"), F.lit(False))
    j = j.filter(of_type & carries("resource_labels", F.col("resource_label_filter")) & carries("labels", F.col("label_filter")))
    al = _align_specs(j, exact, percentiles, aligners)
    keys = ["spec_id", "aligner", "period_s", "reducer", "group_by"]
    reducer = F.col("reducer")
    red_key = F.when(reducer == "NONE", F.col("series_key")).otherwise(
        F.filter("series_key", lambda e: F.array_contains(F.col("group_by"), e["key"])))
    red = (al.groupBy(*keys, red_key.alias("series_key"), "window_start")
             .agg(F.sum("value").alias("_sum"), F.max("value").alias("_max"), F.min("value").alias("_min"),
                  F.avg("value").alias("_mean"), F.count("value").alias("_n"),
                  F.sum((F.col("value") != 0).cast("double")).alias("_ntrue")))
    rvalue = (F.when(reducer.isin("NONE", "REDUCE_SUM"), F.col("_sum"))
               .when(reducer == "REDUCE_MAX", F.col("_max"))
               .when(reducer == "REDUCE_MIN", F.col("_min"))
               .when(reducer == "REDUCE_MEAN", F.col("_mean"))
               .when(reducer == "REDUCE_COUNT", F.col("_n").cast("double"))
               .when(reducer == "REDUCE_COUNT_TRUE", F.col("_ntrue")))
    return red.select(
        "spec_id", "series_key", F.map_from_entries("series_key").alias("labels"), "window_start",
        F.timestamp_add("SECOND", F.col("period_s"), F.col("window_start")).alias("window_end"),
        rvalue.cast("double").alias("value"), F.col("_n").alias("series_count"))


def counter_delta(points: DataFrame, period_seconds: int) -> DataFrame:
    """T7 on cumulative counters: how much each series rose in each window.

    A value below the one before it tells a reset, behind which the counter has
    risen by the value.  A rise between two points is spread evenly over the time
    between them, so one across a window's edge counts for both windows in
    proportion.  Points of one time count in the order of their values.

    A window folds to its first and last point and the rises between its points,
    whatever a series sends; only these states meet across windows, one row per
    series and window, where neighbours' last and first points give the rise over the edge.
    Each window's value is made there from its state and its neighbours, so the windows, which
    may be far more than the points, are neither shuffled nor held by an aggregate.
    """
    keys = ["metric", "series_key"]
    rows = points.filter(F.col("value").isNotNull()).select(
        "metric", sorted_label_entries("labels").alias("series_key"), "ts", "value",
        bucket_start("ts", F.lit(int(period_seconds))).alias("window_start"))

    def rise(value, before):
        return F.when(value >= before, value - before).otherwise(value)

    before = F.lag("value").over(Window.partitionBy(*keys, "window_start").orderBy("ts", "value"))
    states = (rows.withColumn("_rise", F.when(before.isNotNull(), rise(F.col("value"), before)).otherwise(F.lit(0.0)))
              .groupBy(*keys, "window_start").agg(F.sum("_rise").alias("rises"), F.min(F.struct("ts", "value")).alias("first"),
                                                  F.max(F.struct("ts", "value")).alias("last")))
    in_order = Window.partitionBy(*keys).orderBy("window_start")
    met = states.select("*", *[f("last" if f is F.lag else "first").over(in_order).alias(n) for n, f in (("before", F.lag), ("behind", F.lead))],
                        F.lag("window_start").over(in_order).alias("_from"))
    period = F.expr(f"INTERVAL {int(period_seconds)} SECONDS")
    micros = lambda a, b: F.timestamp_diff("MICROSECOND", a, b).cast("double")

    def over(a, b, start):
        """The share of the rise from point a to point b, of different windows, that falls into the window at ``start``."""
        inside = micros(F.greatest(a["ts"], start), F.least(b["ts"], start + period))
        return F.when(a.isNotNull() & b.isNotNull(), rise(b["value"], a["value"]) * inside / micros(a["ts"], b["ts"]))

    # A state's window takes its rises and its share over both edges; the empty windows before it lie over one edge only.
    first, last, before, behind = (F.col(c) for c in ("first", "last", "before", "behind"))
    own = F.col("rises") + F.coalesce(over(before, first, F.col("window_start")), F.lit(0.0)) + F.coalesce(over(last, behind, F.col("window_start")), F.lit(0.0))
    out = met.select(*keys, "window_start", "before", "first", own.alias("_own"),
                     F.explode(F.when(F.col("_from").isNull(), F.array("window_start"))
                               .otherwise(F.slice(F.sequence("_from", "window_start", period), 2, 2147483647))).alias("_at"))
    value = F.when(F.col("_at").eqNullSafe(F.col("window_start")), F.col("_own")).otherwise(over(before, first, F.col("_at")))
    return out.select("metric", "series_key", F.map_from_entries("series_key").alias("labels"), F.col("_at").alias("window_start"),
                      (F.col("_at") + period).alias("window_end"), value.alias("value"))
