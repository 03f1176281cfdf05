"""Mergeable states: percentiles of series (T5) and statistics of SILVER's files.

*Percentiles.*  :func:`percentile_states` keeps one KLL sketch per series and window, a few
kilobytes whatever the number of points.  :func:`merge_states` folds states into longer
windows and fewer labels, and :func:`percentiles` reads any percentile from them, so days,
weeks and cross-series views never see the points again.  The state that a percentile comes
from holds values whose rank is off by at most :data:`RANK_ERROR` of the count, merged or
not (the sketch's published error at ``SKETCH_K`` is 0.0028 with 99 % confidence, and 0.01
lies over three times as far out); states of at most ``SKETCH_K`` values are exact.

*File statistics.*  A data file of a versioned table never changes, so neither do its partial
aggregates.  :class:`FileStatistics` stores them per file, with HyperLogLog sketches for the
distinct counts, and computes them for files it has not seen and for no other.  The report of
any version is the merge of its files' states.

Null and NaN values have no rank: they count in ``point_count`` and not in ``n``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions.scalar import bucket_start, minutes_between, sorted_label_entries
from ledgerwatch.operators.series import keep_labels
from ledgerwatch.operators.upsert import _ts_literal
from ledgerwatch.session import staged
from ledgerwatch.sources.snapshots import CommitConflict, SnapshotTable

#: Size of a percentile sketch and the rank error stated for it.
SKETCH_K, RANK_ERROR = 1000, 0.01
#: log2 of the registers of a distinct-count sketch, and three times its standard error of 1.04 / sqrt(registers).
SKETCH_LG, DISTINCT_ERROR = 14, 0.0244


def percentile_states(points: DataFrame, period_seconds: int, k: int = SKETCH_K) -> DataFrame:
    """One row per series and window: point_count, n, least, greatest, sketch."""
    value = F.when(~F.isnan("value"), F.col("value"))
    return (points.groupBy("metric", sorted_label_entries("labels").alias("series_key"), bucket_start("ts", period_seconds).alias("window_start"))
            .agg(F.count(F.lit(1)).alias("point_count"), F.count(value).alias("n"), F.min(value).alias("least"), F.max(value).alias("greatest"),
                 F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"))
            .select("metric", "series_key", "window_start", F.timestamp_add("SECOND", F.lit(int(period_seconds)), F.col("window_start")).alias("window_end"),
                    "point_count", "n", "least", "greatest", "sketch"))


def merge_states(states: DataFrame, period_seconds: int, group_by: Sequence[str] | None = None, k: int = SKETCH_K) -> DataFrame:
    """States of longer windows, and of the series that keep the labels ``group_by`` (None: all labels).

    ``period_seconds`` is a multiple of the states' own.  Sketches merge map-side first.
    """
    key = F.col("series_key") if group_by is None else keep_labels(F.col("series_key"), list(group_by))
    return (states.groupBy("metric", key.alias("series_key"), bucket_start("window_start", period_seconds).alias("window_start"))
            .agg(F.sum("point_count").alias("point_count"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
                 F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
            .select("metric", "series_key", "window_start", F.timestamp_add("SECOND", F.lit(int(period_seconds)), F.col("window_start")).alias("window_end"),
                    "point_count", "n", "least", "greatest", "sketch"))


def percentiles(states: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    """The states with a column per named quantile in place of the sketch; null where no value has a rank."""
    found = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))).alias(name) for name, q in quantiles.items()]
    return states.select(*[c for c in states.columns if c != "sketch"], *found)


def rank_within(value: Column, estimate: Column, q: float, n: Column, error: float = RANK_ERROR) -> Column:
    """Aggregate: whether the rank of ``estimate`` among the values is within ``error`` of ``q``."""
    below, upto = F.count_if(value < estimate), F.count_if(value <= estimate)
    return (below <= (q + error) * n) & (upto >= (q - error) * n)


# --- statistics of files

def _file_states(rows: DataFrame, file: Column) -> DataFrame:
    empty = lambda c: F.count_if(F.col(c).isNull() | (F.col(c) == "")).alias(f"empty_{c}")
    return rows.groupBy(file.alias("file")).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col("order_id").isNull()).alias("null_order_ids"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_ids"), empty("product"),
        F.count_if(F.col("total_price").isNull() | (F.col("total_price") <= 0)).alias("invalid_prices"), empty("status"),
        F.min("created_at").alias("earliest_order"), F.max("created_at").alias("latest_order"), F.max("_ingested_at").alias("last_ingestion"),
        F.hll_sketch_agg(F.col("customer_id").cast("long"), F.lit(SKETCH_LG)).alias("customers"),
        # by its hash: the sketch passes over empty strings
        F.hll_sketch_agg(F.when(F.col("product").isNotNull(), F.xxhash64("product")), F.lit(SKETCH_LG)).alias("products"))


class FileStatistics(SnapshotTable):
    """Partial aggregates of the files of ``silver``, stored at ``path``."""

    #: A refresh that finds another one ahead starts again so often.
    ATTEMPTS = 5

    def __init__(self, spark: SparkSession, path: str, silver: SnapshotTable):
        self.silver = silver
        found = _file_states(silver.open([]), F.lit("")).schema
        super().__init__(spark, path, T.StructType([T.StructField(f.name, f.dataType) for f in found]), ["file"])

    def refresh(self) -> dict:
        """States for the files of SILVER's latest version that have none, and none for files that no version holds.

        Returns the files and rows that were read for it.
        """
        for attempt in range(self.ATTEMPTS):
            try:
                return self._refresh()
            except CommitConflict:
                if attempt == self.ATTEMPTS - 1:
                    raise

    def _refresh(self) -> dict:
        base, to = self.latest(), self.silver.latest()
        if to is None:
            return {"files_read": 0, "rows_read": 0}
        stored = self.read(base).select("file")
        fresh = self.silver.manifest(to).join(stored, "file", "left_anti").select("file", "rows").collect()
        living = None
        for version in self.silver.versions():  # as many as vacuum leaves
            files = self.silver.manifest(version).select("file")
            living = files if living is None else living.unionByName(files)
        forgotten = stored.join(living, "file", "left_anti")
        gone = self.files_of(forgotten, ["file"], base) if base is not None else []
        if fresh or gone:
            name = F.array_join(F.slice(F.split("_metadata.file_path", "/"), -3, 3), "/")  # relative to the table
            rows = self.open(gone).join(living.distinct(), "file", "left_semi")
            if fresh:
                rows = rows.unionByName(_file_states(self.silver.open([f"{self.silver.path}/{r['file']}" for r in fresh]), name))
            rows = staged(rows.select(*self.schema.names), "file-statistics")
            self.replace(base, gone, rows, rows.count())
        return {"files_read": len(fresh), "rows_read": sum(r["rows"] for r in fresh)}

    def quality(self, as_of, version: int | None = None) -> DataFrame:
        """The columns of ``report.silver_quality``, and ``distinct_customers`` and ``distinct_products`` by sketch."""
        version = self.silver.latest() if version is None else version
        files = self.silver.manifest(version).select("file")
        missing = files.join(self.read().select("file"), "file", "left_anti").limit(1).collect()
        if missing:
            raise ValueError(f"{missing[0][0]} has no statistics: refresh first")
        total = lambda c, name=None: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name or c)
        return self.read().join(files, "file", "left_semi").agg(
            total("total_rows"), total("null_order_ids"), total("null_customer_ids"), total("empty_product", "empty_products"), total("invalid_prices"),
            total("empty_status", "empty_statuses"), F.min("earliest_order").alias("earliest_order"), F.max("latest_order").alias("latest_order"),
            F.max("last_ingestion").alias("last_ingestion"), minutes_between(F.max("last_ingestion"), _ts_literal(as_of)).alias("minutes_since_last_ingest"),
            *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(f"distinct_{c}") for c in ("customers", "products")])
