"""Token counts by delta-maintained rollups.

Totals by source, language and tokenizer version are sums of signed rows: an
insert adds a document and its tokens, a delete takes them away, a revised
count does both.  A batch of changes is folded to one row per key (map-side
first, so a source with a third of all rows is no hot key) and written under
its batch id; a marker written behind it makes the batch count.  Committing a
batch id again does nothing; a batch that broke off before its marker is
written anew over its remains.  Totals sum the committed batches.
``compact`` folds them into one base, remembers their ids and removes what it folded.

Defined cases: null sources and languages are keys of their own; a null text
has no tokens and counts as a document; an unknown sign or null count raises;
an empty batch is a batch; empty tables give no totals; keys whose documents
and tokens are both zero are not reported; other columns are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerwatch.session import drop_path

from .common import byte_rows, map_arrow

KEYS = ["source", "lang", "tokenizer_version"]
_STORED = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"
_MARK = "batch_id string, base boolean"


class Rollup:
    """A rollup store in a folder that all executors share.

    ``commits`` holds a marker per batch, ``deltas`` its rows.  A compaction writes the totals as a base, and
    the ids it folds under ``folded``, where they keep a batch from counting again; these are only filtered by
    Spark, never collected.  What the compaction before it folded goes, so that a reader that listed the
    markers meanwhile still finds the rows it needs.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, schema: str, folder: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.path}/{folder}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], schema)
            raise

    def _bases(self) -> list[str]:
        """Names of the bases, the latest last; a row per compaction that is not removed yet."""
        found = {r["batch_id"] for r in self._read(_MARK, "commits").filter("base").collect()}
        return sorted(found, key=lambda n: int(n.removeprefix("base-")))

    def _folded(self, bases: list[str]) -> DataFrame:
        paths = [f"{self.path}/folded/{b}" for b in bases]
        return self.spark.read.schema("batch_id string").parquet(*paths).distinct() if paths else self.spark.createDataFrame([], "batch_id string")

    def _pending(self, bases: list[str]) -> list[str]:
        """Batches that no base holds: those since the last compaction."""
        marks = self._read(_MARK, "commits").filter("not base").select("batch_id").distinct()
        return sorted(r["batch_id"] for r in marks.join(self._folded(bases), "batch_id", "left_anti").collect())

    def is_committed(self, batch_id: str) -> bool:
        marked = self._read(_MARK, "commits").filter(~F.col("base") & (F.col("batch_id") == batch_id)).select("batch_id")
        return not marked.union(self._folded(self._bases()).filter(F.col("batch_id") == batch_id)).isEmpty()

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add signed rows (source, lang, tokenizer_version, sign, n_tokens); False if the batch is already in."""
        if not re.fullmatch(r"[\w.-]+", batch_id) or re.fullmatch(r"base-\d+|\.+", batch_id):
            raise ValueError(f"a batch id is made of letters, digits, '.', '_' and '-', and names no base: {batch_id!r}")
        if self.is_committed(batch_id):
            return False
        signed = changes.select(*KEYS, F.when(F.col("sign").isin(-1, 1) & F.col("n_tokens").isNotNull(), F.col("sign").cast("long"))
                                .otherwise(F.raise_error("a change needs sign 1 or -1 and a token count").cast("long")).alias("sign"), "n_tokens")
        delta = signed.groupBy(*KEYS).agg(F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"))
        self._write(delta, f"deltas/{batch_id}")
        self._mark(batch_id, False)
        return True

    def _write(self, rows: DataFrame, folder: str):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/{folder}")

    def _mark(self, name: str, base: bool):
        self._write(self.spark.createDataFrame([(name, base)], _MARK).coalesce(1), f"commits/{name}")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, n_docs, n_tokens over all committed batches."""
        bases = self._bases()
        return self._totals(bases[-1:] + self._pending(bases))

    def _totals(self, names: list[str]) -> DataFrame:
        paths = [f"{self.path}/deltas/{n}" for n in names]
        rows = self.spark.read.schema(_STORED).parquet(*paths) if paths else self.spark.createDataFrame([], _STORED)
        return (rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                .filter("n_docs <> 0 or n_tokens <> 0"))

    def compact(self, grace: int = 1) -> None:
        """Fold the batches since the last compaction into a base; later totals read it in their place.

        Markers and rows that the last ``grace`` compactions folded stay for readers under way; older ones are removed.
        A single writer compacts at a time; commits may go on meanwhile.
        """
        bases = self._bases()
        pending = self._pending(bases)
        if pending:
            name = f"base-{(int(bases[-1].removeprefix('base-')) if bases else 0) + 1}"
            self._write(self._totals(bases[-1:] + pending), f"deltas/{name}")
            self._write(self.spark.createDataFrame([(b,) for b in pending], "batch_id string"), f"folded/{name}")
            self._mark(name, True)
            bases.append(name)
        old = bases[:len(bases) - grace]
        gone = self._read(_MARK, "commits").filter("not base").select("batch_id").distinct().join(self._folded(old), "batch_id", "left_semi")
        for batch in [r["batch_id"] for r in gone.collect()]:  # folded since the compaction before: as many as it had pending
            drop_path(self.spark, f"{self.path}/deltas/{batch}")
            drop_path(self.spark, f"{self.path}/commits/{batch}")  # last: while it is there, a removal that broke off is done again
        for base in bases[:max(0, len(bases) - 1 - grace)]:  # its marker stays: it names a folder of folded ids
            drop_path(self.spark, f"{self.path}/deltas/{base}")


def signed_changes(images: DataFrame) -> DataFrame:
    """Signed rows of before and after images (source, lang, tokenizer_version, n_before, n_after).

    A null ``n_before`` is an insert, a null ``n_after`` a delete, equal counts are no change.
    """
    changed = images.filter(~F.col("n_before").eqNullSafe(F.col("n_after")))
    rows = F.array(F.struct(F.lit(-1).alias("sign"), F.col("n_before").cast("long").alias("n_tokens")),
                   F.struct(F.lit(1).alias("sign"), F.col("n_after").cast("long").alias("n_tokens")))
    return changed.select(*KEYS, F.inline(F.filter(rows, lambda r: r["n_tokens"].isNotNull())))


#: Parts of a group of copies, so that a text that a third of all rows repeat is no hot key.
PARTS = 256


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of rows whose text a row of a smaller id has too (null counts as empty); a null id is no copy.

    Rows of equal id and text are not copies of each other.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("sha"))
    keyed = keyed.filter("doc_id is not null").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int"))
    parts = keyed.groupBy("sha", "part").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    groups = parts.groupBy("sha").agg(F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"), F.collect_set("part").alias("parts"))
    first = groups.filter("first_id < last_id").select(F.col("sha").alias("of_sha"), F.explode("parts").alias("of_part"), "first_id")
    return keyed.join(first, (F.col("sha") == F.col("of_sha")) & (F.col("part") == F.col("of_part"))).filter("doc_id > first_id").select("doc_id").distinct()


# --- counting ---------------------------------------------------------------------------------------------------------

#: White space of the split pattern (Unicode White_Space); a token never goes from a non-space to a space.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_CHUNKS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: The public split pattern of byte-level BPE vocabularies (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MEMO = 1 << 18


def whitespace_counter() -> Callable[[list[str]], list[int]]:
    return lambda texts: [len(t.split()) for t in texts]


def bpe_counter(ranks: dict[bytes, int]) -> Callable[[list[str]], list[int]]:
    """Counts tokens of a byte-level BPE, a remembered count per word."""
    import tiktoken

    encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    memo: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        found = [_CHUNKS.findall(t) for t in texts]
        if len(memo) > MEMO:
            memo.clear()
        for word in set(chain.from_iterable(found)).difference(memo):
            memo[word] = len(encoding.encode_ordinary(word))
        return [sum(map(memo.__getitem__, f)) for f in found]
    return count


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def without_repeated_lines(text: str) -> str:
    """The text with the first of each set of equal lines."""
    return "\n".join(dict.fromkeys(text.split("\n")))


def _count(shared, versions: tuple[str, ...], revise):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [bpe_counter(shared.value) if v.startswith("byte_bpe") else whitespace_counter() for v in versions]
        for batch in batches:
            texts = [t.decode("utf-8", "replace") for t in byte_rows(batch.column(3))]
            revised = [revise(t) for t in texts]
            places = [k for k, (a, b) in enumerate(zip(texts, revised)) if a != b]
            for version, counter in zip(versions, counters):
                before = np.array(counter(texts), np.int64)
                after = before.copy()
                if places:
                    after[places] = counter([revised[k] for k in places])
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([version] * len(texts)), pa.array(before), pa.array(after)],
                                                 names=["doc_id", "source", "lang", "tokenizer_version", "n_tokens", "n_revised"])
    return run


def counts(docs: DataFrame, versions: tuple[str, ...] = ("byte_bpe_50k", "whitespace_1"), vocabulary: str = VOCABULARY,
           revise: Callable[[str], str] = without_repeated_lines) -> DataFrame:
    """A row per document and tokenizer version: doc_id, source, lang, tokenizer_version, n_tokens, n_revised.

    ``n_revised`` counts the text after ``revise``.  The vocabulary (under a MB, fixed) is broadcast.  No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary) if any(v.startswith("byte_bpe") for v in versions) else {})
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("text").cast("string"))
    return map_arrow(rows, _count(shared, versions, revise),
                     "doc_id long, source string, lang string, tokenizer_version string, n_tokens long, n_revised long")
