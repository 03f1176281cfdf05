"""Policies of several conditions, with AND, OR and trigger counts.

An episode of a series holds from ``fired_at`` to ``episode_end`` (open where
null).  A condition holds while at least its trigger count of series do, a
policy while all (AND) or any (OR) of its conditions do.  Both are one sweep: the
starts and ends become +1 and -1 at their times, changes at the same time fold
into one (before the shuffle, so a condition that fires on a million series at
once is one row per time), and a running sum is the number that hold.  Where it
crosses the number needed, an interval begins or ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COMBINERS = ("AND", "OR")


def holding(intervals: DataFrame, keys: Sequence[str], needed: Column, start: str = "started_at", end: str = "ended_at") -> DataFrame:
    """keys, started_at, ended_at (null: open): while at least ``needed`` of the keys' intervals hold.

    ``needed`` may read the keys.  Intervals are half-open; one that ends where another starts goes on.
    """
    keys = list(keys)
    changes = intervals.select(*keys, F.explode(F.array(
        F.struct(F.col(start).alias("at"), F.lit(1).cast("long").alias("change")),
        F.struct(F.col(end).alias("at"), F.lit(-1).cast("long").alias("change")))).alias("c"))
    folded = changes.filter(F.col("c.at").isNotNull()).groupBy(*keys, F.col("c.at").alias("_at")).agg(F.sum("c.change").alias("_change"))
    w = Window.partitionBy(*keys).orderBy("_at")
    counted = folded.withColumn("_holds", F.sum("_change").over(w.rowsBetween(Window.unboundedPreceding, 0)) >= needed)
    turned = counted.withColumn("_before", F.coalesce(F.lag("_holds").over(w), F.lit(False))).filter(F.col("_holds") != F.col("_before"))
    return (turned.withColumn("_end", F.lead("_at").over(w)).filter("_holds")
            .select(*keys, F.col("_at").alias("started_at"), F.col("_end").alias("ended_at")))


def condition_intervals(episodes: DataFrame, conditions: DataFrame) -> DataFrame:
    """policy_id, condition_id, started_at, ended_at of conditions (policy_id, condition_id, trigger_count) over their series'
    episodes (policy_id, condition_id, .., fired_at, episode_end)."""
    known = conditions.select(F.col("policy_id").alias("_p"), F.col("condition_id").alias("_c"),
                              F.greatest(F.coalesce("trigger_count", F.lit(1)), F.lit(1)).alias("trigger_count"))
    met = episodes.join(F.broadcast(known), (F.col("policy_id") == F.col("_p")) & (F.col("condition_id") == F.col("_c")))
    keys = ["policy_id", "condition_id", "trigger_count"]
    return holding(met, keys, F.col("trigger_count"), "fired_at", "episode_end").drop("trigger_count")


def policy_intervals(episodes: DataFrame, conditions: DataFrame, policies: DataFrame) -> DataFrame:
    """policy_id, started_at, ended_at of policies (policy_id, combiner AND or OR).

    ``conditions`` and ``policies`` are configuration tables.
    """
    number = conditions.groupBy("policy_id").agg(F.count(F.lit(1)).alias("_n"))
    known = F.col("combiner").isin(*COMBINERS)
    needed = F.when(F.col("combiner") == "AND", F.col("_n")).when(known, F.lit(1)).otherwise(
        F.raise_error(F.concat(F.lit("unknown combiner "), F.coalesce("combiner", F.lit("null")))).cast("long"))
    need = policies.join(number, "policy_id").select(F.col("policy_id").alias("_p"), needed.cast("long").alias("_needed"))
    met = condition_intervals(episodes, conditions).join(F.broadcast(need), F.col("policy_id") == F.col("_p"))
    return holding(met, ["policy_id", "_needed"], F.col("_needed")).drop("_needed")
