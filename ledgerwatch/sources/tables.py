"""Table sources and sinks: SILVER table, marts, reports, structured logs.

SILVER is a table of versions (:mod:`ledgerwatch.sources.snapshots`), its files
ordered by ``order_date, region, status, order_id`` with their least and greatest
values in the manifest (S6).  An upsert (:meth:`SilverTable.upsert`)

1. casts the batch, splits it into valid rows and rejects, reduces it to the
   latest row per key and stages it; rejects are always written, by batch id;
2. finds the files that hold a key of the batch (a key scan of the files whose
   key range meets the batch's), wherever the row's ``created_at`` put it;
3. merges their rows with the batch into a staging folder under the cluster's
   shared ``spark.checkpoint.dir``, which cuts the lineage;
4. writes the result as new files and publishes a version in which they stand
   in place of the old ones.

A reader sees one version to its end.  An upsert that loses against another
writer is run again on the version that won.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.operators.upsert import ACTIONS, cast_projection, initial_load, latest_or_rejected, merge_counts, merge_upsert
from ledgerwatch.session import drop_path, scratch_path
from ledgerwatch.sources.contracts import (
    BUSINESS_COLUMNS,
    FAILURE_RECORD,
    ORDER_KEY,
    RAW_ORDERS,
    SILVER_CLUSTER,
    SILVER_ORDERS,
    SILVER_PARTITION,
)
from ledgerwatch.sources.snapshots import ROWS_PER_FILE, CommitConflict, SnapshotTable


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def write_partitioned(df: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = True,
                      key: str = "order_id") -> None:
    """Write by ``order_date`` with files sorted on the cluster columns.

    Range partitioning on ``(order_date, key)`` gives each task a contiguous
    run of dates, so a date lands in one or a few files instead of one file per
    task, and a date holding a large share of rows is still split across tasks
    by ``key``.  AQE coalesces the range partitions to the data size.
    """
    cols = [SILVER_PARTITION] + ([key] if key in df.columns else [])
    (df.repartitionByRange(*cols)
       .sortWithinPartitions(SILVER_PARTITION, *[c for c in SILVER_CLUSTER if c in df.columns])
       .write.mode(mode)
       .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
       .partitionBy(SILVER_PARTITION)
       .parquet(path))


@dataclass
class UpsertResult:
    counts: DataFrame          # rows per branch (_action, rows)
    changed_dates: DataFrame   # order_date values with an insert or update
    rejects_path: str          # folder of this batch's rejected rows
    base: int | None = None    # version the batch was merged into
    version: int | None = None # version that holds it (the base, if it changed nothing)
    gone: tuple = ()           # files of the base that the version replaces


#: More partition dates than this are not listed: the target is then read whole, with the same result.
MAX_DATES = 20_000


def _delete_partitions(spark: SparkSession, path: str, column: str, values: list) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(os.path.join(path, f"{column}={v}"))
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)


class SilverTable(SnapshotTable):
    """SILVER ``orders`` at ``path``."""

    #: An upsert that finds its base version overtaken starts again so often.
    ATTEMPTS = 5

    def __init__(self, spark: SparkSession, path: str, rows_per_file: int = ROWS_PER_FILE):
        super().__init__(spark, path, SILVER_ORDERS, [SILVER_PARTITION, *SILVER_CLUSTER, ORDER_KEY], rows_per_file=rows_per_file)

    def create_if_missing(self) -> None:
        """CREATE TABLE IF NOT EXISTS (typed, empty)."""
        if self.latest() is None:
            try:
                self.commit(None, self.manifest())
            except CommitConflict:
                pass  # created meanwhile

    def count(self) -> DataFrame:
        return self.read().agg(F.count(F.lit(1)).alias("row_count"))

    def upsert(self, raw: DataFrame, ingest_ts=None, extra_order: tuple = (), rejects_path: str | None = None,
               batch_id: str | None = None) -> UpsertResult:
        """MERGE a RAW batch; returns branch counts, the changed dates and the version.

        ``ingest_ts`` defaults to the current time (S8 default of
        ``_ingested_at``).  Rejected rows (NULL contract columns, Q11) go to
        ``rejects_path`` (default: beside the table), in a folder per
        ``batch_id``: a replay of the batch writes the same folder again.
        """
        self.create_if_missing()
        ts = F.current_timestamp().cast("timestamp_ntz") if ingest_ts is None else ingest_ts
        # The batch is evaluated once: its rejects and its latest rows are read from one staged copy.
        typed = cast_projection(raw, keep=[c for c in extra_order if c not in BUSINESS_COLUMNS])
        folded, batch = latest_or_rejected(typed, extra_order=list(extra_order)), scratch_path(self.spark, "silver-batch")
        folded.write.parquet(batch)
        held = self.spark.read.schema(folded.schema).parquet(batch)
        rejects = held.filter(F.col("_reject_reason").isNotNull()).select(*typed.columns, "_reject_reason")
        rejected = f"{(rejects_path or self.path + '_rejects').rstrip('/')}/batch_id={batch_id or uuid.uuid4().hex}"
        rejects.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(rejected)
        source = held.filter(F.col("_reject_reason").isNull()).select(*BUSINESS_COLUMNS)
        try:
            for attempt in range(self.ATTEMPTS):
                try:
                    return self._merge(source, ts, rejected)
                except CommitConflict:
                    if attempt == self.ATTEMPTS - 1:
                        raise
        finally:
            drop_path(self.spark, batch)

    def _merge(self, source: DataFrame, ts, rejected: str) -> UpsertResult:
        base = self.latest()
        touched = self.files_of(source, [ORDER_KEY], base)
        stage = scratch_path(self.spark, "silver-stage")
        try:
            merged = merge_upsert(self.open(touched), source, ts) if touched else initial_load(source, ts).withColumn("_action", F.lit("inserted"))
            merged.write.parquet(stage)
            staged = self.spark.read.schema(
                T.StructType(SILVER_ORDERS.fields + [T.StructField("_action", T.StringType())])).parquet(stage)
            counts = [tuple(r) for r in merge_counts(staged).collect()]
            changed = staged.filter(F.col("_action").isin("inserted", "updated")).select(SILVER_PARTITION).distinct()
            dates = [r[0] for r in changed.collect()]
            version = self.replace(base, touched, staged, sum(n for _, n in counts)) if dates else base
        finally:
            drop_path(self.spark, stage)
        return UpsertResult(self.spark.createDataFrame(counts, "_action string, rows long"),
                            self.spark.createDataFrame([(d,) for d in dates], f"{SILVER_PARTITION} date"), rejected, base, version, touched)


def refresh_revenue_mart(silver: SilverTable, changed_dates: DataFrame, mart_path: str) -> None:
    """Incremental A1: recompute the revenue mart only for changed order dates.

    A1 groups by ``order_date`` (= DATE(created_at), never changed by an
    update), so a batch can only alter the mart rows of the dates it inserted or
    updated.  Those dates are read from the files of SILVER that hold them, aggregated
    and written over the same partitions of the mart (dynamic overwrite).  A
    changed date left without rows (e.g. every order cancelled) has its mart
    partition removed; that list is at most the batch's changed dates.
    """
    from ledgerwatch.operators.marts import revenue_by_product
    spark = silver.spark
    dates = [r[0] for r in changed_dates.select(SILVER_PARTITION).distinct().limit(MAX_DATES + 1).collect()]
    if not dates:
        return
    stored = silver.read(where={SILVER_PARTITION: (min(dates), max(dates))})
    part = stored.filter(F.col(SILVER_PARTITION).isin(dates)) if len(dates) <= MAX_DATES else \
        stored.join(changed_dates, SILVER_PARTITION, "left_semi")
    fresh = revenue_by_product(part)
    stage = scratch_path(spark, "revenue-stage")
    fresh.write.parquet(stage)
    staged = spark.read.schema(fresh.schema).parquet(stage)
    write_partitioned(staged, mart_path, mode="overwrite" if _exists(spark, mart_path) else "errorifexists",
                      key="product")
    emptied = changed_dates.distinct().join(staged.select(SILVER_PARTITION).distinct(), SILVER_PARTITION, "left_anti")
    _delete_partitions(spark, mart_path, SILVER_PARTITION, [r[0] for r in emptied.collect()])
    drop_path(spark, stage)


def branch_counts_row(counts: DataFrame) -> DataFrame:
    """Pivot branch counts into one row with a column per action."""
    return counts.groupBy().pivot("_action", list(ACTIONS)).agg(F.first("rows")).na.fill(0)


def write_report(df: DataFrame, path: str) -> None:
    """CREATE OR REPLACE / WRITE_TRUNCATE -> full (static) overwrite."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_json_report(summary_json: DataFrame, path: str) -> None:
    """The JSON summary document(s) as a text file."""
    summary_json.coalesce(1).write.mode("overwrite").text(path)


def parse_failure_records(logs: DataFrame) -> DataFrame:
    """S12 read: structured failure records from log text payloads."""
    rec = F.from_json("text_payload", FAILURE_RECORD)
    return (logs.filter(F.col("text_payload").startswith("{"))
                .select("ts", "severity", rec.alias("r"))
                .filter(F.col("r.alert_type").isNotNull())
                .select("ts", "severity", "r.*"))


def failure_record_json(records: DataFrame) -> DataFrame:
    """S12 write: the 15-field failure record as one JSON string per row."""
    return records.select(F.to_json(F.struct(*[F.col(f.name) for f in FAILURE_RECORD.fields])).alias("text_payload"))


def read_typed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Typed scan against a fixed contract (no inference)."""
    reader = spark.read.schema(schema)
    return reader.format(fmt).load(path) if fmt != "parquet" else reader.parquet(path)


def jdbc_options(url: str, table: str, properties: dict | None = None, partition_column: str | None = None, lower=None, upper=None,
                 partitions: int = 1, fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a JDBC read; more than one partition needs a column and both of its bounds."""
    if partitions < 1:
        raise ValueError(f"partitions: {partitions}")
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **{k: str(v) for k, v in (properties or {}).items()}}
    if partitions > 1:
        if partition_column is None or lower is None or upper is None:
            raise ValueError("a read in several partitions needs partition_column, lower and upper")
        if lower > upper:
            raise ValueError(f"lower {lower} is above upper {upper}")
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions)}
    return options


def jdbc_bounds_query(table: str, partition_column: str) -> str:
    """What to read for the bounds of a split."""
    return f"(SELECT MIN({partition_column}) AS low, MAX({partition_column}) AS high FROM {table}) AS bounds"


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None, partition_column: str = ORDER_KEY,
              lower: int | None = None, upper: int | None = None, partitions: int = 16, schema: T.StructType = RAW_ORDERS) -> DataFrame:
    """S1 option: the source table over JDBC, split on a numeric key, cast to the contract.

    Bounds that are not given are read from the table first.  They only deal out the rows: values
    beyond them, and nulls, are read by the outer partitions.
    """
    if partitions > 1 and (lower is None or upper is None):
        ends = spark.read.format("jdbc").options(**jdbc_options(url, jdbc_bounds_query(table, partition_column), properties)).load().first()
        if ends["low"] is None:  # an empty table needs no split
            partitions = 1
        else:
            lower, upper = (ends["low"] if lower is None else lower), (ends["high"] if upper is None else upper)
    rows = spark.read.format("jdbc").options(**jdbc_options(url, table, properties, partition_column, lower, upper, partitions)).load()
    return cast_projection(rows, schema)


def table_path(root: str, name: str) -> str:
    return os.path.join(root, name)
