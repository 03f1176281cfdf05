"""CDC upsert: typed cast, NOT NULL contract, latest row per key, MERGE.

Plan shape (one action when written): the source is cast, split into valid
rows and rejects, reduced to one row per ``order_id`` and full-outer joined
with the target on ``order_id``.  The reduction is an aggregate of
``max(struct(order keys..., payload...))`` (planned as a sort aggregate), so a
key that holds a third of all rows is folded map-side before the shuffle, as
Spark's window group limit does for a ``row_number`` filter.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.sources.contracts import (
    BUSINESS_COLUMNS,
    DEFAULT_SOURCE,
    NOT_NULL_COLUMNS,
    ORDER_KEY,
    RAW_ORDERS,
    SILVER_ORDERS,
    SILVER_PARTITION,
    UPDATE_COLUMNS,
)

ACTIONS = ("inserted", "updated", "unchanged", "untouched")


def cast_projection(raw: DataFrame, schema: T.StructType = RAW_ORDERS,
                    keep: Sequence[str] = (), safe: bool = False) -> DataFrame:
    """Project the contract columns with explicit casts.

    With ANSI mode on (Spark default) a bad value fails the job like the
    warehouse CAST would; ``safe=True`` uses ``try_cast`` so bad values become
    NULL and are caught by :func:`split_rejects`.
    """
    cols = [(F.col(f.name).try_cast(f.dataType) if safe else F.col(f.name).cast(f.dataType)).alias(f.name)
            for f in schema.fields]
    return raw.select(*cols, *[F.col(c) for c in keep])


def split_rejects(df: DataFrame, required: Sequence[str] = NOT_NULL_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Rows violating the NOT NULL contract go to a reject output.

    Returns ``(valid, rejects)``; rejects carry ``_reject_reason`` listing the
    NULL columns.  Both outputs are plain filters of the same scan.
    """
    ok, reason = _contract(required)
    return df.filter(ok), df.filter(~ok).withColumn("_reject_reason", reason)


def _contract(required: Sequence[str]) -> tuple[Column, Column]:
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return ok, F.concat(F.lit("null:"), missing)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str],
                   method: str = "aggregate") -> DataFrame:
    """Keep the row with the greatest ``order_by`` tuple per key.

    Equivalent to ``QUALIFY ROW_NUMBER() OVER (PARTITION BY key ORDER BY
    order_by DESC...) = 1``.  Every remaining column joins the ordering as a
    final tie-break, so the result is deterministic even when whole rows tie on
    the order keys (Q1).  NULL order values rank last, as with DESC in SQL.

    ``method="aggregate"`` (default) folds each key before the shuffle and is skew
    safe; ``method="window"`` uses ``row_number`` (WindowGroupLimit).
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    if method == "window":
        from pyspark.sql import Window
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order + rest])
        return (df.withColumn("_rn", F.row_number().over(w))
                  .filter(F.col("_rn") == 1).drop("_rn"))
    packed = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_w")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in df.columns if c not in keys]) \
              .select(*df.columns)


def latest_per_key_batches(df: DataFrame, key: str, order_by: Sequence[str],
                           batches: dict[str, Column]) -> dict[str, DataFrame]:
    """J1 for several batches of one input in one aggregate.

    ``batches`` maps a name to the predicate selecting that batch's rows; the
    result maps each name to its latest row per ``key`` (same ordering and
    tie-break as :func:`latest_per_key`).  The input is scanned and shuffled
    once: one hash aggregate on ``key`` keeps ``max(struct)`` per batch, and
    every output reads that aggregate, so the shared exchange is reused and
    the outputs keep its partitioning on ``key`` (a later join of two batches
    on ``key`` needs no new exchange).
    """
    order = list(order_by)
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    agg = df.groupBy(key).agg(*[F.max(F.when(pred, packed)).alias(f"_w_{name}")
                                for name, pred in batches.items()])
    # One row per (key, batch) through a generator that reads every batch
    # column: the optimizer cannot prune the aggregate per output, so all
    # outputs share one plan below the batch filter (exchange reuse).
    tagged = agg.select(key, F.explode(F.array(*[
        F.struct(F.lit(name).alias("batch"), F.col(f"_w_{name}").alias("row")) for name in batches
    ])).alias("_b"))
    out = {}
    for name in batches:
        out[name] = (tagged.filter((F.col("_b.batch") == name) & F.col("_b.row").isNotNull())
                           .select(key, *[F.col(f"_b.row.{c}").alias(c) for c in order + rest])
                           .select(*df.columns))
    return out


def _ts_literal(ts) -> Column:
    if isinstance(ts, Column):
        return ts
    if isinstance(ts, str):
        return F.lit(ts).cast("timestamp_ntz")
    if isinstance(ts, _dt.datetime):
        return F.lit(ts.replace(tzinfo=None)).cast("timestamp_ntz")
    raise TypeError(f"unsupported timestamp {ts!r}")


def empty_silver(spark) -> DataFrame:
    return spark.createDataFrame([], SILVER_ORDERS)


def merge_upsert(target: DataFrame, source: DataFrame, ingest_ts,
                 key: str = ORDER_KEY, with_action: bool = True) -> DataFrame:
    """M1-M5: MERGE ``source`` (one row per key) into ``target``.

    * matched and ``source.updated_at > target.updated_at`` -> update the eight
      business columns and ``_ingested_at``; ``created_at``/``_source`` kept (M2)
    * matched, not newer -> row unchanged (M3; replays are idempotent)
    * not matched -> insert with ``_source='datastream_cdc'`` (M4)
    * target rows absent from the source stay (M5, no delete branch)

    ``ingest_ts`` replaces ``CURRENT_TIMESTAMP()`` so results are reproducible.
    Returns the new target state (SILVER contract) plus ``_action``.
    """
    ts = _ts_literal(ingest_ts)
    t = target.select(*BUSINESS_COLUMNS, "_ingested_at", "_source", F.lit(True).alias("_in_t"))
    s = source.select(*BUSINESS_COLUMNS, F.lit(True).alias("_in_s"))
    t_cols = {c: f"_t_{c}" for c in BUSINESS_COLUMNS if c != key}
    s_cols = {c: f"_s_{c}" for c in BUSINESS_COLUMNS if c != key}
    t = t.withColumnsRenamed(t_cols)
    s = s.withColumnsRenamed(s_cols)
    j = t.join(s, on=key, how="full_outer")
    action = (F.when(F.col("_in_t").isNull(), F.lit("inserted"))
               .when(F.col("_in_s").isNull(), F.lit("untouched"))
               .when(F.col("_s_updated_at") > F.col("_t_updated_at"), F.lit("updated"))
               .otherwise(F.lit("unchanged")))
    j = j.withColumn("_action", action)
    take_source = F.col("_action").isin("inserted", "updated")
    out = [F.col(key)]
    for c in BUSINESS_COLUMNS:
        if c == key:
            continue
        if c in UPDATE_COLUMNS:
            out.append(F.when(take_source, F.col(s_cols[c])).otherwise(F.col(t_cols[c])).alias(c))
        else:  # created_at: only an insert sets it
            out.append(F.when(F.col("_action") == "inserted", F.col(s_cols[c]))
                        .otherwise(F.col(t_cols[c])).alias(c))
    out.append(F.when(take_source, ts).otherwise(F.col("_ingested_at")).alias("_ingested_at"))
    out.append(F.when(F.col("_action") == "inserted", F.lit(DEFAULT_SOURCE))
                .otherwise(F.col("_source")).alias("_source"))
    out.append(F.to_date(F.when(F.col("_action") == "inserted", F.col(s_cols["created_at"]))
                          .otherwise(F.col(t_cols["created_at"]))).alias(SILVER_PARTITION))
    if with_action:
        out.append(F.col("_action"))
    return j.select(*out)


def initial_load(source: DataFrame, ingest_ts) -> DataFrame:
    """MERGE into an empty target: every row takes the insert branch (M4).

    Same result as ``merge_upsert(empty, source)`` without the join, so the
    output keeps the source's hash partitioning on ``order_id`` (the latest-row
    aggregate's), and a later merge on ``order_id`` needs no new exchange.
    """
    ts = _ts_literal(ingest_ts)
    return source.select(*BUSINESS_COLUMNS, ts.alias("_ingested_at"), F.lit(DEFAULT_SOURCE).alias("_source"),
                         F.to_date("created_at").alias(SILVER_PARTITION))


def merge_counts(merged: DataFrame) -> DataFrame:
    """Branch counts of a merge (inserted / updated / unchanged / untouched)."""
    return merged.groupBy("_action").agg(F.count(F.lit(1)).alias("rows"))


def prepare_source(raw: DataFrame, order_by: Sequence[str] = ("updated_at",),
                   extra_order: Sequence[str] = (), cast: bool = True) -> tuple[DataFrame, DataFrame]:
    """RAW -> (latest valid row per order_id, rejects).

    ``extra_order`` names lineage columns in ``raw`` used as tie-breaks after
    ``updated_at`` (they are dropped from the result).
    """
    keep = [c for c in extra_order if c not in BUSINESS_COLUMNS]
    typed = cast_projection(raw, keep=keep) if cast else raw
    valid, rejects = split_rejects(typed)
    latest = latest_per_key(valid, ORDER_KEY, list(order_by) + list(extra_order))
    return latest.select(*BUSINESS_COLUMNS), rejects


def latest_or_rejected(typed: DataFrame, order_by: Sequence[str] = ("updated_at",), extra_order: Sequence[str] = (),
                       required: Sequence[str] = NOT_NULL_COLUMNS) -> DataFrame:
    """Both outputs of :func:`prepare_source` in one pass: the latest valid row per key, and every rejected row with its ``_reject_reason``.

    A rejected row is a group of its own.  The groups lie within their key, so rows that
    come by key (as RAW's join leaves them) are folded where they are.
    """
    ok, reason = _contract(required)
    marked = typed.withColumn("_reject_reason", F.when(~ok, reason)).withColumn("_id", F.monotonically_increasing_id())
    marked = marked.withColumn("_row", F.when(F.col("_reject_reason").isNotNull(), F.col("_id"))).drop("_id")
    return latest_per_key(marked, [ORDER_KEY, "_row"], list(order_by) + list(extra_order)).drop("_row")
