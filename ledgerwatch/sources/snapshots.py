"""Tables of immutable files in numbered versions.

A version is a manifest, one row per data file with its row count and the least
and greatest value of the columns that scans filter on.  A commit writes its new
files and its manifest under names of their own, where no reader looks, and then
publishes them by renaming one small file to the next version's number.  That
rename fails if the number is taken, so of two writers on the same base one wins
and the other gets :class:`CommitConflict`; a writer that breaks off before it
changes nothing.  Readers resolve a version once and read its files, which stay
until :meth:`SnapshotTable.vacuum` removes versions.

Files hold rows in a space-filling (Z) order over the cluster columns: each
column's values are cut at quantiles into 2^BITS steps, and the bits of the steps
are interleaved.  A filter on any of the columns then meets few files, and the
manifest tells which before anything is opened.

The rename is atomic where the file system's is (HDFS); a store without one
needs a commit service in its place.  Listing the versions and collecting the
paths a scan opens are the only work on the driver.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Steps per cluster column (2^BITS), and the accuracy of their quantiles.
BITS, ACCURACY = 5, 2000
ROWS_PER_FILE = 2_000_000
#: A write takes a task per so many rows, up to the number of slots, however few files they would fill.
ROWS_PER_TASK = 20_000


class CommitConflict(RuntimeError):
    """Another writer has published the next version."""


class Files:
    """The Hadoop file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(folder))]

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, text: str, path: str) -> bool:
        """Put a whole file in place at once; False if the name is taken."""
        held = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self.fs.create(self.path(held), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        kind = getattr(self.jvm, "org.apache.hadoop.fs.Options$Rename")
        options = self.gateway.new_array(kind, 1)
        options[0] = kind.NONE
        target = self.path(path)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.makeQualified(self.fs.getUri(), self.fs.getWorkingDirectory()).toUri(), self.conf)
        try:
            context.rename(context.makeQualified(self.path(held)), context.makeQualified(target), options)
            return True
        except Exception as e:
            self.delete(held)
            if "FileAlreadyExists" in str(e):
                return False
            raise

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


def ordinal(column: str, kind: T.DataType) -> Column:
    """A number in the order of the values, as far as a step needs: strings by their first seven bytes."""
    c = F.col(column)
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def z_ordered(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """``df`` with ``_z``, the interleaved steps of ``columns``; one aggregate finds the quantiles (2^bits a column on the driver).

    Numbers, steps and ``_z`` are projections of their own: each is made once a row, however often the next one reads it.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cuts = [k / (1 << bits) for k in range(1, 1 << bits)]
    names = df.columns
    found = df.agg(*[F.percentile_approx(ordinal(c, kinds[c]), cuts, ACCURACY).alias(f"c{k}") for k, c in enumerate(columns)]).first()
    steps, z = [], F.lit(0).cast("long")
    for k, c in enumerate(columns):
        step = F.lit(0)
        # equal edges stay: few values are spread over all steps
        for edge, times in sorted(Counter(found[k] or []).items()):
            step = step + (F.col(f"_v{k}") >= F.lit(float(edge))).cast("int") * F.lit(times)
        steps.append(F.when(F.col(c).isNull(), F.lit(0)).otherwise(step).cast("long").alias(f"_s{k}"))
        for bit in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(F.col(f"_s{k}"), bit).bitwiseAND(F.lit(1).cast("long")), bit * len(columns) + k))
    values = [F.coalesce(ordinal(c, kinds[c]), F.lit(float("-inf"))).alias(f"_v{k}") for k, c in enumerate(columns)]
    return df.select(*names, *values).select(*names, *steps).select(*names, z.alias("_z"))


class SnapshotTable:
    """A table of ``schema`` in versions under ``path``, its files ordered by ``cluster`` with least and greatest values of ``stats``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, cluster: Sequence[str], stats: Sequence[str] | None = None,
                 rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.cluster, self.stats, self.rows_per_file = list(cluster), list(stats or cluster), rows_per_file
        kinds = {f.name: f.dataType for f in schema.fields}
        self._manifest_schema = T.StructType(
            [T.StructField("file", T.StringType()), T.StructField("rows", T.LongType())]
            + [T.StructField(f"{c}_{end}", kinds[c]) for c in self.stats for end in ("min", "max")])

    # --- versions

    def versions(self) -> list[int]:
        return sorted(int(n) for n in Files(self.spark, self.path).names(f"{self.path}/_versions") if n.isdigit())

    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def _entry(self, version: int) -> dict:
        return json.loads(Files(self.spark, self.path).read(f"{self.path}/_versions/{version:012d}"))

    def manifest(self, version: int | None = None) -> DataFrame:
        """file (relative), rows and the statistics of a version's files (default: the latest)."""
        version = self.latest() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], self._manifest_schema)
        return self.spark.read.schema(self._manifest_schema).parquet(f"{self.path}/_manifests/{self._entry(version)['manifest']}")

    def note(self, version: int) -> dict:
        """What was published with a version."""
        return self._entry(version).get("note") or {}

    def difference(self, before: int, after: int) -> tuple[list[str], list[str]]:
        """The files that only the one version holds, and those that only the other does."""
        one, other = self.manifest(before).select("file"), self.manifest(after).select("file")
        return tuple([f"{self.path}/{r[0]}" for r in a.join(b, "file", "left_anti").collect()] for a, b in ((one, other), (other, one)))

    def files_of(self, rows: DataFrame, keys: Sequence[str], version: int | None = None) -> list[str]:
        """The files of a version that hold a key of ``rows``: a scan of the key columns of those whose range meets the rows'."""
        known = [c for c in keys if c in self.stats]
        ends = rows.agg(F.count(F.lit(1)), *[f(c) for c in known for f in (F.min, F.max, F.count)]).first()
        if not ends[0]:
            return []
        # a null lies in no range
        where = {c: (ends[3 * k + 1], ends[3 * k + 2]) for k, c in enumerate(known) if ends[3 * k + 3] == ends[0]}
        files = self.files(version, where)
        if not files:
            return []
        asked = rows.select(*[F.col(c).alias(f"_k_{c}") for c in keys])
        same = F.lit(True)
        for c in keys:
            same = same & (F.col(c).eqNullSafe(F.col(f"_k_{c}")))
        stored = self.open(files).select(*keys, F.col("_metadata.file_path").alias("_file"))
        held = {r[0].rsplit("/", 1)[1] for r in stored.join(asked, same, "left_semi").select("_file").distinct().collect()}
        return [f for f in files if f.rsplit("/", 1)[1] in held]

    def commit(self, base: int | None, manifest: DataFrame, note: dict | None = None) -> int:
        """Publish ``manifest``, with a note, as the version behind ``base``."""
        name, version = uuid.uuid4().hex, 0 if base is None else base + 1
        manifest.select(*self._manifest_schema.names).coalesce(1).write.parquet(f"{self.path}/_manifests/{name}")
        entry = json.dumps({"version": version, "manifest": name, "note": note})
        if not Files(self.spark, self.path).publish(entry, f"{self.path}/_versions/{version:012d}"):
            raise CommitConflict(f"version {version} of {self.path} is taken")
        return version

    # --- reading

    def files(self, version: int | None = None, where: Mapping[str, tuple] | None = None) -> list[str]:
        """The files a scan has to open: those whose values can lie in the (low, high) of every column named (None: open end)."""
        found = self.manifest(version)
        for column, (low, high) in (where or {}).items():
            if low is not None:
                found = found.filter(F.col(f"{column}_max") >= F.lit(low))
            if high is not None:
                found = found.filter(F.col(f"{column}_min") <= F.lit(high))
        return [f"{self.path}/{r[0]}" for r in found.select("file").collect()]

    def open(self, files: Sequence[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)

    def read(self, version: int | None = None, where: Mapping[str, tuple] | None = None) -> DataFrame:
        """A version's rows (default: the latest), with both ends of ``where`` within."""
        rows = self.open(self.files(version, where))
        for column, (low, high) in (where or {}).items():
            rows = rows.filter((F.col(column) >= F.lit(low)) if low is not None else F.lit(True))
            rows = rows.filter((F.col(column) <= F.lit(high)) if high is not None else F.lit(True))
        return rows

    # --- writing

    def write_files(self, rows: DataFrame, n_rows: int) -> DataFrame:
        """Write rows (read more than once) as new files in cluster order; the manifest rows of these files."""
        if not n_rows:
            return self.spark.createDataFrame([], self._manifest_schema)
        folder = f"data/{uuid.uuid4().hex}"
        n_files = max(-(-n_rows // self.rows_per_file), min(-(-n_rows // ROWS_PER_TASK), self.spark.sparkContext.defaultParallelism))
        rows = rows.select(*self.schema.names)
        # one column's Z order is its own order
        ordered, order = (z_ordered(rows, self.cluster), ["_z", *self.cluster]) if len(self.cluster) > 1 else (rows, self.cluster)
        # a stated number of range partitions is not merged into one by its bytes
        ordered.repartitionByRange(n_files, *order).sortWithinPartitions(*order).drop("_z").write.parquet(f"{self.path}/{folder}")
        name = F.concat(F.lit(f"{folder}/"), F.col("_metadata.file_name"))
        written = self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")
        ends = [end(c).alias(f"{c}_{n}") for c in self.stats for n, end in (("min", F.min), ("max", F.max))]
        return written.groupBy(name.alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)

    def replace(self, base: int | None, gone: Sequence[str], rows: DataFrame, n_rows: int, note: dict | None = None) -> int:
        """The version behind ``base`` without the files ``gone`` and with ``rows``."""
        relative = self.spark.createDataFrame([(f.removeprefix(self.path + "/"),) for f in gone], "file string")
        kept = self.manifest(base).join(relative, "file", "left_anti")
        return self.commit(base, kept.unionByName(self.write_files(rows, n_rows)), note)

    def optimize(self) -> int | None:
        """All rows in cluster order, in files of ``rows_per_file``: a version of its own."""
        base = self.latest()
        if base is None:
            return None
        n_rows = self.manifest(base).agg(F.sum("rows")).first()[0] or 0
        return self.commit(base, self.write_files(self.read(base), n_rows))

    def vacuum(self, keep: int = 1) -> None:
        """Forget all but the latest ``keep`` versions and delete the files that only they hold.

        Files of a commit under way belong to no version and stay.
        """
        versions = self.versions()
        old, kept = versions[:-keep], versions[-keep:]
        if not old:
            return
        paths = lambda some: self.spark.read.schema(self._manifest_schema).parquet(
            *[f"{self.path}/_manifests/{self._entry(v)['manifest']}" for v in some]).select("file").distinct()
        gone = [r[0] for r in paths(old).join(paths(kept), "file", "left_anti").collect()]
        names = [self._entry(v)["manifest"] for v in old]
        files = Files(self.spark, self.path)
        for version in old:  # first the versions: nobody starts to read what is deleted next
            files.delete(f"{self.path}/_versions/{version:012d}")
        for path in [*gone, *[f"_manifests/{n}" for n in names]]:
            files.delete(f"{self.path}/{path}")
