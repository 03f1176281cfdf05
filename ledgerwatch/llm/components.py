"""Connected components of an edge table by alternating large and small stars.

Every round is two equi-joins on grouped minima; its edges are written to the
shared folder, so a lost executor costs at most one round.  A node with very
many edges is a skewed join key (AQE splits the edge side) and its minimum is
folded before the shuffle.  Nothing is collected but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import staged

MAX_ROUNDS = 60


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(least, F.col("u") == F.col("k"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them; here u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    tied = edges.join(least, F.col("u") == F.col("k")).filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u long, v long) to (node, root) for every node that is not a root; the root is the smallest node.

    Loops and null ends are no edges; an empty table gives no rows.
    """
    now = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _signature(now)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        now = staged(_small(_large(now)), "edges")
        after = _signature(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
