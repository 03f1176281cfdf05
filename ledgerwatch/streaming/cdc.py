"""Continuous CDC upsert into SILVER.

The CDC feed lands files per table (``<root>/<table>/``); only tables on the
include-list are read, and each is merged into a SILVER table of its own
(:func:`start_table_upserts`).  Every micro-batch runs the batch upsert
(``SilverTable.upsert``) through ``foreachBatch``; rejected rows are written by
batch id.  Replaying a batch after a
failure is harmless: rows already merged compare as not newer (M3) and stay.
The trigger stands for the delivery cadence (15 minutes by default, or
``available_now`` for a catch-up run of the backfill).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerwatch.operators.changes import ReplicaTable, silver_rows
from ledgerwatch.sources.contracts import RAW_ORDERS
from ledgerwatch.sources.tables import SilverTable, refresh_revenue_mart
from ledgerwatch.streaming.lag import LagListener, observed


def cdc_stream(spark: SparkSession, root: str, include_tables: list[str] = ("public_orders",),
               schema: T.StructType = RAW_ORDERS, fmt: str = "parquet",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Typed stream over the include-listed tables (adds ``_table``)."""
    streams = []
    for t in include_tables:
        r = spark.readStream.schema(schema).format(fmt)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        streams.append(r.load(os.path.join(root, t)).withColumn("_table", F.lit(t)))
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out


def start_silver_upsert(feed: DataFrame, silver: SilverTable, checkpoint_location: str,
                        processing_time: str | None = "15 minutes", available_now: bool = False,
                        ingest_ts=None, query_name: str | None = None,
                        revenue_mart_path: str | None = None, table: str = "public_orders",
                        rejects_path: str | None = None, lag_points_path: str | None = None) -> StreamingQuery:
    """Start the continuous MERGE of one table's rows of the feed; returns the running query.

    With ``revenue_mart_path`` every micro-batch also refreshes the revenue
    mart for the dates it changed (incremental A1).  With ``lag_points_path``
    every micro-batch adds its largest lag there as a metric point of the stream
    ``table`` (``streaming.lag``).
    """
    if lag_points_path:
        spark = feed.sparkSession
        feed = observed(feed, f"lag-{table}")
        spark.streams.addListener(LagListener(spark, f"lag-{table}", lag_points_path, table))

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.filter(F.col("_table") == table).drop("_table")
        result = silver.upsert(rows, ingest_ts=ingest_ts, rejects_path=rejects_path, batch_id=f"{table}-{epoch_id}")
        if revenue_mart_path:
            refresh_revenue_mart(silver, result.changed_dates, revenue_mart_path)

    w = feed.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint_location)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def start_table_upserts(spark: SparkSession, root: str, targets: dict[str, SilverTable], checkpoint_root: str,
                        **settings) -> dict[str, StreamingQuery]:
    """One stream per included table, each merged into its own target."""
    return {t: start_silver_upsert(cdc_stream(spark, root, [t]), silver, f"{checkpoint_root.rstrip('/')}/{t}", table=t, **settings)
            for t, silver in targets.items()}


def start_change_feed(records: DataFrame, replica: ReplicaTable, silver: SilverTable, checkpoint_location: str,
                      processing_time: str | None = "15 minutes", available_now: bool = False, ingest_ts=None) -> StreamingQuery:
    """Change records (``operators.changes.CHANGES``, of events and backfill chunks alike) into the replica, what changed into SILVER.

    A batch that broke off behind the replica's commit reports its rows again, and SILVER ignores what it has.
    """
    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        applied = replica.apply(batch)
        silver.upsert(silver_rows(applied.changed), ingest_ts=ingest_ts, batch_id=f"changes-{epoch_id}")

    w = records.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint_location)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()
