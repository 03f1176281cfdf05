"""Marts kept by signed deltas of SILVER (A1, A2 behind M1).

Two versions of SILVER differ in a few files.  The rows of the files that went
count with sign -1, those of the files that came with +1; rows that an upsert
only carried along cancel out in every sum.  A mart keeps, per group, the signed
sums from which its columns follow (counts, totals, sums behind averages), so a
refresh reads the files in which the versions differ and the mart's files that
hold a group of theirs, and nothing else.

A minimum or maximum cannot be taken back.  It is kept as long as no row that
went reaches it; groups that lost one, and they alone, are computed anew from
the files of SILVER that can hold them.

The version of SILVER that a mart shows is published together with the mart, so
a refresh that breaks off, or runs twice, counts nothing twice.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions.scalar import minutes_between
from ledgerwatch.session import drop_path, scratch_path, staged
from ledgerwatch.sources.snapshots import ROWS_PER_FILE, SnapshotTable
from ledgerwatch.sources.tables import SilverTable


@dataclass(frozen=True)
class MartDefinition:
    """``keys`` and ``sums`` over the rows that pass ``where``; ``extremes`` (value, min or max); ``view``: the mart's columns."""

    keys: Mapping[str, Column]
    sums: Mapping[str, Column]
    view: Mapping[str, Column]
    cluster: list[str]
    where: Column | None = None
    extremes: Mapping[str, tuple[Column, str]] = field(default_factory=dict)
    #: Key columns that SILVER's files are ordered by: where to look for a group's rows.
    located_by: str | None = None


def revenue_definition() -> MartDefinition:
    """A1: revenue per product, region and order date."""
    money = F.col("total_price").cast("decimal(38,2)")
    return MartDefinition(
        keys={"product": F.col("product"), "region": F.col("region"), "order_date": F.col("order_date")},
        sums={"order_count": F.lit(1).cast("long"), "total_quantity": F.col("quantity"), "revenue": money},
        extremes={"first_order": (F.col("created_at"), "min"), "last_order": (F.col("created_at"), "max")},
        view={"product": F.col("product"), "region": F.col("region"), "order_date": F.col("order_date"), "order_count": F.col("order_count"),
              "total_quantity": F.col("total_quantity"), "total_revenue": F.round("revenue", 2),
              "avg_order_value": F.round((F.col("revenue").cast("decimal(28,2)") / F.col("order_count")).cast("decimal(38,6)"), 2),
              "first_order": F.col("first_order"), "last_order": F.col("last_order")},
        where=~F.col("status").isin("cancelled"), cluster=["order_date", "region", "product"], located_by="order_date")


def status_definition() -> MartDefinition:
    """A2: orders per status, region and status date."""
    return MartDefinition(
        keys={"status": F.col("status"), "region": F.col("region"), "status_date": F.to_date("updated_at")},
        sums={"order_count": F.lit(1).cast("long"), "value": F.col("total_price").cast("decimal(38,2)"),
              "minutes": minutes_between("created_at", "updated_at").cast("long")},
        view={"status": F.col("status"), "region": F.col("region"), "status_date": F.col("status_date"), "order_count": F.col("order_count"),
              "total_value": F.round("value", 2), "avg_processing_minutes": F.round(F.col("minutes") / F.col("order_count"), 1)},
        cluster=["status_date", "status", "region"])


class MaintainedMart(SnapshotTable):
    """A mart over ``silver`` at ``path``, refreshed by what changed."""

    def __init__(self, spark: SparkSession, path: str, silver: SilverTable, definition: MartDefinition, rows_per_file: int = ROWS_PER_FILE):
        self.silver, self.definition = silver, definition
        super().__init__(spark, path, self._state(silver.open([]), F.lit(1)).schema, definition.cluster, rows_per_file=rows_per_file)
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in self.schema.fields])

    def _rows(self, rows: DataFrame) -> DataFrame:
        d = self.definition
        kept = rows.filter(d.where) if d.where is not None else rows
        return kept.select(*[c.alias(k) for k, c in d.keys.items()], *[c.alias(k) for k, c in d.sums.items()],
                           *[c.alias(k) for k, (c, _) in d.extremes.items()], *(["_sign"] if "_sign" in rows.columns else []))

    def _state(self, rows: DataFrame, sign: Column) -> DataFrame:
        d = self.definition
        kinds = dict(self._rows(rows).dtypes)
        sums = [F.sum(F.col(k) * sign.cast("long") if not kinds[k].startswith("decimal") else F.when(sign > 0, F.col(k)).otherwise(-F.col(k)))
                .cast("decimal(38,2)" if kinds[k].startswith("decimal") else "long").alias(k) for k in d.sums]
        ends = [(F.min if how == "min" else F.max)(F.when(sign > 0, F.col(k))).alias(k) for k, (_, how) in d.extremes.items()]
        return self._rows(rows).groupBy(*d.keys).agg(*sums, *ends)

    def refresh(self) -> dict:
        """Bring the mart to SILVER's latest version: version, and the SILVER rows that were read for it."""
        to, base = self.silver.latest(), self.latest()
        if to is None:
            return {"version": base, "rows_read": 0}
        known = self.silver.versions()
        shown = self.note(base).get("silver") if base is not None else None
        if shown == to:
            return {"version": base, "rows_read": 0}
        if shown not in known:  # the first time, or SILVER has forgotten that version
            return self._publish(base, self.files() if base is not None else [], self._state(self.silver.read(to), F.lit(1)), to,
                                 self.silver.manifest(to).agg(F.sum("rows")).first()[0] or 0)
        gone, came = self.silver.difference(shown, to)
        rows_read = (self.silver.open(gone).count(), self.silver.open(came).count())
        signed = self.silver.open(gone).withColumn("_sign", F.lit(-1)).unionByName(self.silver.open(came).withColumn("_sign", F.lit(1)))
        delta = self._delta(signed)
        path = scratch_path(self.spark, "mart-delta")
        delta.write.parquet(path)
        delta = self.spark.read.schema(delta.schema).parquet(path)
        touched = self.files_of(delta, self.definition.cluster, base)
        merged, again = self._merged(delta, self.open(touched), to)
        out = self._publish(base, touched, merged, to, sum(rows_read) + again, held=bool(self.definition.extremes))
        drop_path(self.spark, path)
        return out

    def _delta(self, signed: DataFrame) -> DataFrame:
        """Signed sums of the groups that changed, the extremes of the rows that went and of those that came."""
        d = self.definition
        rows = self._rows(signed)
        kinds = dict(rows.dtypes)
        sign = F.col("_sign")
        sums = [F.sum(F.col(k) * sign if not kinds[k].startswith("decimal") else F.when(sign > 0, F.col(k)).otherwise(-F.col(k)))
                .cast("decimal(38,2)" if kinds[k].startswith("decimal") else "long").alias(k) for k in d.sums]
        ends = [((F.min if how == "min" else F.max)(F.when(sign * s > 0, F.col(k)))).alias(f"{n}_{k}")
                for k, (_, how) in d.extremes.items() for n, s in (("_came", 1), ("_went", -1))]
        moved = F.lit(False)
        for k in d.sums:
            moved = moved | (F.col(k) != 0)
        for k in d.extremes:
            moved = moved | ~F.col(f"_came_{k}").eqNullSafe(F.col(f"_went_{k}"))
        return rows.groupBy(*d.keys).agg(*sums, *ends).filter(moved)

    def _merged(self, delta: DataFrame, stored: DataFrame, to: int) -> tuple[DataFrame, int]:
        """The groups of ``stored`` and ``delta`` together, and the SILVER rows read again; of a mart with extremes they lie in staged files."""
        d = self.definition
        keys = list(d.keys)
        old = stored.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(k).alias(f"_o_{k}") for k in [*d.sums, *d.extremes]])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        joined = delta.withColumn("_d", F.lit(True)).join(old.withColumn("_s", F.lit(True)), same, "full_outer")
        out = [F.when(F.col("_d"), F.col(k)).otherwise(F.col(f"_k_{k}")).alias(k) for k in keys]
        kinds = {f.name: f.dataType for f in self.schema.fields}
        out += [(F.coalesce(F.col(k), F.lit(0)) + F.coalesce(F.col(f"_o_{k}"), F.lit(0))).cast(kinds[k]).alias(k) for k in d.sums]
        lost = F.lit(False)
        for k, (_, how) in d.extremes.items():
            best = F.least if how == "min" else F.greatest
            went, came, kept = F.col(f"_went_{k}"), F.col(f"_came_{k}"), F.col(f"_o_{k}")
            reached = (went <= kept) if how == "min" else (went >= kept)
            regained = (came <= kept) if how == "min" else (came >= kept)  # a row as far out is there again
            lost = lost | (F.coalesce(reached, F.lit(False)) & ~F.coalesce(regained, F.lit(False)))
            out.append(best(came, kept).alias(k))
        merged = joined.select(*out, lost.alias("_lost")).filter(F.col("order_count") != 0)
        if not d.extremes:
            return merged.drop("_lost"), 0
        path = scratch_path(self.spark, "mart-merged")
        merged.write.parquet(path)
        merged = self.spark.read.schema(merged.schema).parquet(path)
        groups = merged.filter("_lost").select(*keys)
        span = groups.agg(F.min(d.located_by), F.max(d.located_by), F.count(F.lit(1))).first()
        if not span[2]:
            return merged.drop("_lost"), 0
        rows = self.silver.read(to, where={d.located_by: (span[0], span[1])}).join(groups.select(d.located_by).distinct(), d.located_by, "left_semi")
        anew = self._state(rows, F.lit(1)).join(groups, keys, "left_semi")
        return merged.filter(~F.col("_lost")).drop("_lost").unionByName(staged(anew, "mart-anew")), rows.count()

    def _publish(self, base: int | None, gone: list[str], rows: DataFrame, silver_version: int, rows_read: int, held: bool = False) -> dict:
        if held:  # staged already
            return {"version": self.replace(base, gone, rows, rows.count(), {"silver": silver_version}), "rows_read": rows_read}
        path = scratch_path(self.spark, "mart-stage")
        rows.select(*self.schema.names).write.parquet(path)
        fresh = self.spark.read.schema(self.schema).parquet(path)
        version = self.replace(base, gone, fresh, fresh.count(), {"silver": silver_version})
        drop_path(self.spark, path)
        return {"version": version, "rows_read": rows_read}

    def mart(self, version: int | None = None) -> DataFrame:
        return self.read(version).select(*[c.alias(k) for k, c in self.definition.view.items()])
