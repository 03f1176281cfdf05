"""Change records with source positions, and the handoff of a chunked backfill.

A change record carries the row after the change (before it, for a delete), its
operation and its position in the source's log.  A backfill reads the source in
chunks of keys while the log goes on: the log position is noted before (low) and
behind (high) a chunk's read, so its rows show a state no older than low.  A row
of a chunk therefore stands for its key at position low, behind an event at low
itself; an event in the window (low, high], which the read may or may not have
seen, has a greater position and wins, as does any later one.  An event at or
before low is older than the chunk's row and loses, however late it arrives.

So each record has a place in one order per key, the state of a key is its
greatest record, and chunks and events can be applied in any order, in any
batches, and again.  Deleted keys stay as tombstones, or a replayed insert would
bring them back.

``ReplicaTable`` keeps that state (RAW ``public_orders``) in versions.  SILVER
has no delete branch (M5): it takes the rows that changed and are not deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.operators.upsert import latest_per_key
from ledgerwatch.session import drop_path, scratch_path
from ledgerwatch.sources.contracts import BUSINESS_COLUMNS, ORDER_KEY, RAW_ORDERS
from ledgerwatch.sources.snapshots import ROWS_PER_FILE, CommitConflict, Files, SnapshotTable

INSERT, UPDATE, DELETE, READ = "insert", "update", "delete", "read"
OPERATIONS = (INSERT, UPDATE, DELETE, READ)
#: What a record is beside the row: its operation, the position of an event, the window of a chunk.
RECORD = [T.StructField("_op", T.StringType()), T.StructField("_position", T.LongType()),
          T.StructField("_low", T.LongType()), T.StructField("_high", T.LongType())]
CHANGES = T.StructType(RAW_ORDERS.fields + RECORD)
REPLICA = T.StructType(RAW_ORDERS.fields + [T.StructField("_op", T.StringType()), T.StructField("_position", T.LongType()),
                                            T.StructField("_from_chunk", T.BooleanType())])
_PLACE = ["_position", "_from_chunk"]


def events(rows: DataFrame, operation, position) -> DataFrame:
    """Change records of log events: ``operation`` and ``position`` are columns."""
    return rows.select(*BUSINESS_COLUMNS, operation.alias("_op"), position.cast("long").alias("_position"),
                       F.lit(None).cast("long").alias("_low"), F.lit(None).cast("long").alias("_high"))


def chunk(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Change records of a chunk read between the log positions ``low`` and ``high``."""
    if low > high:
        raise ValueError(f"a chunk's window ends before it begins: {low} > {high}")
    return rows.select(*BUSINESS_COLUMNS, F.lit(READ).alias("_op"), F.lit(None).cast("long").alias("_position"),
                       F.lit(low).cast("long").alias("_low"), F.lit(high).cast("long").alias("_high"))


def chunks(source: Callable[[], DataFrame], position: Callable[[], int], bounds: list[int], key: str = ORDER_KEY) -> Iterator[DataFrame]:
    """The backfill of a source by key ranges cut at ``bounds``: notes the log position around each read.

    ``source()`` reads the source as it is now, ``position()`` is its log position.  A chunk is written to the
    shared folder within its window; the window would mean nothing to a read that is only planned.
    """
    edges = [None, *sorted(bounds), None]
    for a, b in zip(edges, edges[1:]):
        low = position()
        rows = source()
        inside = (F.col(key) >= a if a is not None else F.lit(True)) & (F.col(key) < b if b is not None else F.lit(True))
        if a is None:
            inside = inside | F.col(key).isNull() if b is not None else F.lit(True)
        path = scratch_path(rows.sparkSession, "backfill-chunk")
        rows.filter(inside).select(*BUSINESS_COLUMNS).write.parquet(path)
        yield chunk(rows.sparkSession.read.schema(RAW_ORDERS).parquet(path), low, position())


def handed_off(records: DataFrame, stream_position: int) -> DataFrame:
    """One row: high (the greatest end of a chunk's window), caught_up (the feed has passed it, so no chunk is ahead of the log)."""
    return records.agg(F.max("_high").alias("high")).select(
        "high", F.coalesce(F.col("high") <= F.lit(stream_position), F.lit(True)).alias("caught_up"))


def placed(records: DataFrame) -> DataFrame:
    """Records with their place in the order of their key; an unknown operation or a record without a place raises."""
    known = F.col("_op").isin(*OPERATIONS) & F.coalesce("_position", "_low").isNotNull()
    checked = F.when(known, F.col("_op")).otherwise(F.raise_error(F.concat(F.lit("not a change record: "), F.coalesce("_op", F.lit("null")))))
    return records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_ORDERS.fields], checked.alias("_op"),
                          F.coalesce("_position", "_low").cast("long").alias("_position"), F.col("_position").isNull().alias("_from_chunk"))


def latest_records(records: DataFrame) -> DataFrame:
    """The state that records leave: one row per key, folded before the shuffle; records of one place go by their content."""
    return latest_per_key(placed(records).filter(F.col(ORDER_KEY).isNotNull()), ORDER_KEY, _PLACE)


@dataclass
class Applied:
    version: int
    changed: DataFrame  # the state of every key that a record of the batch won, now or when the batch came before


class ReplicaTable(SnapshotTable):
    """RAW ``public_orders`` as a replica of the source: the greatest record of every key."""

    ATTEMPTS = 5

    def __init__(self, spark: SparkSession, path: str, rows_per_file: int = ROWS_PER_FILE):
        super().__init__(spark, path, REPLICA, [ORDER_KEY], rows_per_file=rows_per_file)

    def apply(self, records: DataFrame) -> Applied:
        """Take a batch of change records, of chunks and events alike.

        The changed rows are written to the shared folder, so they can be read after later batches.
        """
        for attempt in range(self.ATTEMPTS):
            try:
                return self._apply(records)
            except CommitConflict:
                if attempt == self.ATTEMPTS - 1:
                    raise
        raise AssertionError("not reached")

    def _apply(self, records: DataFrame) -> Applied:
        if self.latest() is None:
            try:
                self.commit(None, self.manifest())
            except CommitConflict:
                pass
        base = self.latest()
        batch, stage = (scratch_path(self.spark, f"replica-{n}") for n in ("batch", "stage"))
        flagged = T.StructType(REPLICA.fields + [T.StructField("_newer", T.BooleanType())])
        read = lambda path, schema=REPLICA: self.spark.read.schema(schema).parquet(path)
        latest_records(records).write.parquet(batch)
        touched = self.files_of(read(batch), [ORDER_KEY], base)
        if not touched:  # no stored row to compare with: the batch is what it changed
            held = read(batch).withColumn("_newer", F.lit(True))
            n_rows = held.count()
            return Applied(self.replace(base, [], read(batch), n_rows) if n_rows else base, held.drop("_newer"))
        # Batch and stored rows meet once; what the batch won and what stays are two folders of one write.
        whole = lambda some, name: some.select(F.col(ORDER_KEY), F.struct(*REPLICA.names).alias(name))
        place = lambda name: F.struct(*[F.col(f"{name}.{c}") for c in _PLACE])
        met = whole(read(batch), "_new").join(whole(self.open(touched), "_old"), ORDER_KEY, "full_outer")
        newer = F.col("_new").isNotNull() & (F.col("_old").isNull() | (place("_new") > place("_old")))
        # a batch that comes again reports its rows again: what follows may have broken off the first time
        again = F.col("_new").isNotNull() & F.col("_old").isNotNull() & (place("_new") == place("_old"))
        outcome = lambda row, part, new: F.struct(F.col(row).alias("row"), F.lit(part).alias("_part"), F.lit(new).alias("_newer"))
        rows = met.select(F.explode(F.filter(F.array(
            F.when(newer, outcome("_new", "won", True)).otherwise(outcome("_old", "kept", False)),
            F.when(again, outcome("_new", "won", False))), lambda x: x.isNotNull())).alias("x"))
        rows.select("x.row.*", "x._newer", "x._part").write.partitionBy("_part").parquet(stage)
        n_new, n_kept = (read(stage, T.StructType([*flagged.fields, T.StructField("_part", T.StringType())])).agg(
            F.count_if("_newer"), F.count_if(F.col("_part") == "kept")).first())
        held = read(f"{stage}/_part=won", flagged) if self._folder(f"{stage}/_part=won") else self.spark.createDataFrame([], flagged)
        if n_new:
            stays = held.filter("_newer").drop("_newer")
            if n_kept:
                stays = stays.unionByName(read(f"{stage}/_part=kept"))
            base = self.replace(base, touched, stays, n_new + n_kept)
        drop_path(self.spark, f"{stage}/_part=kept")
        drop_path(self.spark, batch)
        return Applied(base, held.drop("_newer"))

    def _folder(self, path: str) -> bool:
        files = Files(self.spark, path)
        return files.fs.exists(files.path(path))

    def current(self, version: int | None = None) -> DataFrame:
        """The source's rows: all keys but the deleted ones."""
        return self.read(version).filter(F.col("_op") != DELETE).select(*BUSINESS_COLUMNS)


def silver_rows(changed: DataFrame) -> DataFrame:
    """What SILVER merges of a batch's changes (M5: deleted rows stay there)."""
    return changed.filter(F.col("_op") != DELETE).select(*BUSINESS_COLUMNS)
