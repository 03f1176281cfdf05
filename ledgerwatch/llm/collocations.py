"""Phrase collocations by direct-address tiling.

Texts become sequences of word numbers in blocks of one language.  Words that
occur ``least`` times or more get ids by frequency rank, and the plane of id
pairs falls into square tiles of ``SIDE`` ranks.  A block counts its neighbouring
pairs tile by tile: a tile with many pairs by a dense bincount over its cells,
all others together as sorted coordinates (COO).  Tiles are dealt to buckets, and
a bucket sums what the blocks counted, dense tiles by direct address, sparse
ones by merging sorted keys.  The pairs that reach ``least`` are ranked in turn,
their ids take the place of their first word, and the next round counts (pair,
word): phrases of three words, then of four.  A phrase that reaches ``least``
holds only phrases that do, so each round looks only at places where both parts
of its overlap are left.

What grows is shuffled as integer arrays per block and bucket.  Tiles of the most
frequent words fill the same bucket from all blocks: it is salted by block and
summed in two steps once there are more than ``merge`` blocks, and its second
step is dealt by tiles so that few tiles are held at a time.  No dictionary and
no count passes through the driver.

Scores are exact: counts are 64-bit integers, products are decimals.

Defined cases: a null or empty text has no words; a null language is ``und``;
rows count as often as they stand, ids are not read; pieces without a word do
nothing; phrases of equal score and frequency go by their UTF-8 bytes; empty tables
give no rows; a text may be of any length (a text is never split over blocks);
other columns are not read, whatever their names.  At most 2^31 words or phrases
of a length can be ranked; more raise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .blocks import pack, pack64, record_batches, unpack, unpack64
from .common import byte_rows, map_arrow, new_path, staged

LEAST, LONGEST, TOP, SHARE = 30, 4, 2000, 80
#: A byte that stands in no UTF-8 text: the end of a piece.
BREAK = b"\xff"
_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)
#: Words of a block, blocks summed in one step, pairs a bucket's second step should hold.
BLOCK, MERGE, HELD = 1 << 20, 512, 1 << 21
#: Ranks along a tile's side (2^10), and pairs from which a tile is counted densely.
BITS, DENSE = 10, 1 << 16
SIDE = 1 << BITS
_LOW = SIDE - 1
_MOST = 1 << 31
#: Dense tiles a task holds at a time, of 8 MB each.
DENSE_HELD = 12


def tokens(text: bytes) -> list[bytes]:
    """Words in order, with a BREAK between pieces."""
    return text.lower().translate(_PIECES).replace(BREAK, b" \xff ").split()  # bytes: A-Z alone; only blanks and tabs are left


# --- blocks -----------------------------------------------------------------------------------------------------------

_CUT = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("lang", pa.string()), ("place", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])
_CUT_DDL = "block long, kind int, lang string, place int, n long, data binary"
WORD, SEQUENCE = 0, 1


class _Open:
    """The block of a language that is being filled."""

    def __init__(self):
        self.numbers, self.parts, self.size = {BREAK: 0}, [], 0

    def add(self, words: list[bytes]):
        numbers = self.numbers
        for word in set(words).difference(numbers):
            numbers[word] = len(numbers)
        words.append(BREAK)
        self.parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)


def _cut(block_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        blocks: dict[str, _Open] = {}
        held = 0

        def rows(lang: str, done: _Open):
            sequence = np.concatenate(done.parts)
            counts = np.bincount(sequence, minlength=len(done.numbers))
            for word, k in done.numbers.items():
                if k:
                    yield block, WORD, lang, k, int(counts[k]), word
            yield block, SEQUENCE, lang, 0, len(sequence), pack(sequence)

        def close(lang: str):
            nonlocal block, held
            done = blocks.pop(lang)
            held -= done.size
            yield from record_batches(rows(lang, done), _CUT)
            block += 1

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1))):
                words = tokens(text)
                if not words:
                    continue
                now = blocks.setdefault(lang, _Open())
                before = now.size
                now.add(words)
                held += now.size - before
                if now.size >= block_words:
                    yield from close(lang)
                while held >= 2 * block_words:
                    yield from close(max(blocks, key=lambda x: blocks[x].size))
        for lang in list(blocks):
            yield from close(lang)
    return run


# --- pairs of a block -------------------------------------------------------------------------------------------------

_ROWS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
_ROWS_DDL = "block long, kind int, bucket int, a binary, b binary"
REPLY, STATE, PAIRS = 0, 1, 2


def pair_keys(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Tile first, then the cell within it."""
    i, j = i.astype(np.int64), j.astype(np.int64)
    return (i >> BITS) << 41 | (j >> BITS) << 20 | (i & _LOW) << BITS | j & _LOW


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    tile = (keys >> 20).astype(np.uint64)
    mixed = (tile ^ (tile >> np.uint64(21))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def count_pairs(i: np.ndarray, j: np.ndarray, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the distinct pairs and how often they occur: dense tiles by bincount, the others as sorted COO."""
    if not len(i):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, across = pair_keys(i, j), int(j.max() >> BITS) + 1
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if (int(i.max() >> BITS) + 1) * across <= 1 << 22:  # else tiles are too many for one to be dense
        tile = (i >> BITS).astype(np.int64) * across + (j >> BITS)
        full = np.bincount(tile) >= dense
        for t in np.flatnonzero(full).tolist():
            inside = keys[tile == t]
            counts = np.bincount(inside & (1 << 20) - 1, minlength=1 << 20)
            cells = np.flatnonzero(counts)
            found.append((cells | (inside[0] >> 20 << 20), counts[cells]))
        keys = keys[~full[tile]]
    found.append(np.unique(keys, return_counts=True))
    del keys
    return _merged(found) if len(found) > 1 else found[0]


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal keys summed, keys sorted."""
    keys, counts = np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _packed(keys: np.ndarray) -> bytes:
    return pack64(np.diff(keys, prepend=0))


def _unpacked(data) -> np.ndarray:
    return np.cumsum(unpack64(data))


def _round(block: int, words: np.ndarray, units: np.ndarray, length: int, buckets: int, last: bool) -> Iterator[tuple]:
    """A block's rows of a round: its pairs of (unit of ``length`` words, word behind it), and the sequences for the next.

    Ids are one more than ranks here; 0 is no word that counts.
    """
    here = max(0, len(words) - length)
    fits = (units[:here] > 0) & (words[length:length + here] > 0)
    if length > 1:
        fits &= units[1:here + 1] > 0
    at = np.flatnonzero(fits)
    keys, counts = count_pairs(units[at].astype(np.int64) - 1, words[at + length].astype(np.int64) - 1)
    if not last and len(keys):
        left = np.zeros(len(words), bool)
        left[at + length] = True
        if length == 1:
            left[at] = True  # the first words of pairs are units of the round
        yield block, STATE, None, pack(np.where(left, words, 0)), pack(units)
    bucket = _bucket(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts) if len(keys) else ():
        yield block, PAIRS, int(bucket[part[0]]), _packed(keys[part]), pack64(counts[part])


def _first_round(buckets: int):
    """Rows sorted by block, ids of words before the sequence: the round of word pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            now, places, ids = None, [], []
            for batch in batches:
                blocks, kinds, at, of = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
                sequences = np.flatnonzero(kinds == SEQUENCE).tolist()
                start = 0
                for stop in [*sequences, len(blocks)]:
                    # word rows of one block, or of blocks whose sequence holds none of them (there are none such)
                    if stop > start:
                        if blocks[start] != now:
                            now, places, ids = blocks[start], [], []
                        places.append(at[start:stop])
                        ids.append(of[start:stop])
                    if stop == len(blocks):
                        break
                    if blocks[stop] == now:
                        sequence = unpack(batch.column(4)[stop].as_py())
                        of_number = np.zeros(int(sequence.max()) + 1, np.uint32)
                        of_number[np.concatenate(places)] = np.concatenate(ids) + 1
                        words = of_number[sequence]
                        yield from _round(int(now), words, words, 1, buckets, False)
                    now, places, ids = None, [], []
                    start = stop + 1
        yield from record_batches(rows(), _ROWS)
    return run


def _next_round(length: int, buckets: int, last: bool):
    """Rows sorted by block, replies before the state: units of ``length`` words take their ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            now, replies = None, []
            for batch in batches:
                for block, kind, a, b in zip(*(batch.column(k).to_pylist() for k in range(4))):
                    if block != now:
                        now, replies = block, []
                    if kind == REPLY:
                        replies.append((_unpacked(a), unpack(b)))
                        continue
                    if not replies:
                        continue
                    keys, ids = np.concatenate([k for k, _ in replies]), np.concatenate([i for _, i in replies])
                    order = np.argsort(keys)
                    keys, ids, replies = keys[order], ids[order], []
                    words, units = unpack(a), unpack(b)
                    here = max(0, len(words) - length + 1)
                    fits = np.flatnonzero((units[:here] > 0) & (words[length - 1:length - 1 + here] > 0))
                    asked = pair_keys(units[fits].astype(np.int64) - 1, words[fits + length - 1].astype(np.int64) - 1)
                    at = np.searchsorted(keys, asked)
                    at[at == len(keys)] = 0
                    met = keys[at] == asked
                    longer = np.zeros(len(words), np.uint32)
                    longer[fits[met]] = ids[at[met]] + 1
                    del keys, ids, fits, asked, at, met, units
                    yield from _round(block, words, longer, length, buckets, last)
        yield from record_batches(rows(), _ROWS)
    return run


# --- sums of a bucket -------------------------------------------------------------------------------------------------

class Tiles:
    """Sums of pairs: dense tiles by direct address, the others as sorted COO."""

    def __init__(self, dense: int = DENSE, pending: int = 1 << 20):
        self.dense: dict[int, np.ndarray] = {}
        self.coo, self.pending, self.size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
        self.threshold, self.bound = dense, pending

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Sorted distinct keys and their counts."""
        for tile, sums in self.dense.items():
            a, b = np.searchsorted(keys, [tile << 20, (tile + 1) << 20])
            if b > a:
                sums[keys[a:b] & (1 << 20) - 1] += counts[a:b]
                keys, counts = np.delete(keys, slice(a, b)), np.delete(counts, slice(a, b))
        if len(keys):
            self.pending.append((keys, counts))
            self.size += len(keys)
        if self.size > self.bound:
            self._compact()

    def _compact(self) -> None:
        if not self.pending:
            return
        keys, counts = _merged([self.coo, *self.pending])
        self.pending, self.size = [], 0
        if len(self.dense) < DENSE_HELD and len(keys):
            tiles, first, n = np.unique(keys >> 20, return_index=True, return_counts=True)
            for k in np.flatnonzero(n >= self.threshold)[:DENSE_HELD - len(self.dense)][::-1].tolist():
                cut = slice(int(first[k]), int(first[k] + n[k]))
                sums = self.dense[int(tiles[k])] = np.zeros(1 << 20, np.int64)
                sums[keys[cut] & (1 << 20) - 1] = counts[cut]
                keys, counts = np.delete(keys, cut), np.delete(counts, cut)
        self.coo = keys, counts

    def items(self, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self._compact()
        for tile, sums in self.dense.items():
            cells = np.flatnonzero(sums >= least)
            yield cells | (tile << 20), sums[cells]
        often = self.coo[1] >= least
        yield self.coo[0][often], self.coo[1][often]


def _sum(least: int, parts: int, dense: int):
    """Rows (bucket, part, a, b) sorted by bucket and part: the sums of each, as rows dealt to ``parts`` by tile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(bucket: int, tiles: Tiles):
            for keys, counts in tiles.items(least):
                if not len(keys):
                    continue
                part = _bucket(keys, 1 << 30) % parts
                for p in np.unique(part).tolist():
                    yield bucket, p, _packed(keys[part == p]), pack64(counts[part == p])

        def rows():
            now, tiles = None, None
            for batch in batches:
                for bucket, part, a, b in zip(*(batch.column(k).to_pylist() for k in range(4))):
                    if (bucket, part) != now:
                        if now:
                            yield from out(now[0], tiles)
                        now, tiles = (bucket, part), Tiles(dense)
                    tiles.add(_unpacked(a), unpack64(b))
            if now:
                yield from out(now[0], tiles)
        yield from record_batches(rows(), _SUMS)
    return run


_SUMS = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
_SUMS_DDL = "bucket int, part int, a binary, b binary"


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bucket, a, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            keys, counts = _unpacked(a), unpack64(b)
            for at in range(0, len(keys), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys[part]), bucket, np.int32)), pa.array(keys[part]), pa.array(counts[part])],
                                                 names=["bucket", "key", "f"])


def sums(pairs: DataFrame, least: int, salts: int, parts: int, dense: int = DENSE) -> DataFrame:
    """bucket, key, f of the pairs that occur ``least`` times or more."""
    def step(rows: DataFrame, n: int, of: int) -> DataFrame:
        return map_arrow(rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part"), _sum(n, of, dense), _SUMS_DDL)

    rows = pairs.select("bucket", F.pmod("block", F.lit(salts)).cast("int").alias("part"), "a", "b")
    rows = step(rows, least, 1) if salts == 1 else step(step(rows, 1, parts), least, 1)
    return map_arrow(rows, _spread, "bucket int, key long, f long")


def ranked(df: DataFrame, name: str, *order) -> DataFrame:
    """The rows with ``id``: 0, 1, .. in the given order.  The driver holds a count per partition."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"))
    rows = staged(placed, name)
    first, total = [], 0
    for r in sorted(rows.groupBy("_part").count().collect()):
        first.append((r["_part"], total))
        total += r["count"]
    if total >= _MOST:
        raise ValueError(f"{total} {name}: more than can be ranked")
    offsets = df.sparkSession.createDataFrame(first, "_of int, _first long")
    return rows.join(F.broadcast(offsets), F.col("_part") == F.col("_of")).select(*df.columns, (F.col("_row") + F.col("_first")).alias("id"))


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and salt, ranked keys before the blocks' pairs: what a block needs to know of its pairs."""
    def rows():
        now, keys, ids = None, [], []
        for batch in batches:
            buckets, salts, kinds, blocks, key, of = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(6))
            at = np.concatenate([[0], np.flatnonzero((np.diff(buckets) != 0) | (np.diff(salts) != 0) | (kinds[1:] == PAIRS)) + 1, [len(buckets)]])
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                if a == b:
                    continue
                if (buckets[a], salts[a]) != now:
                    now, keys, ids = (buckets[a], salts[a]), [], []
                if kinds[a] != PAIRS:
                    keys.append(key[a:b].astype(np.int64))
                    ids.append(of[a:b].astype(np.int64))
                    continue
                if isinstance(keys, list):
                    keys, ids = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, ids))
                    order = np.argsort(keys)
                    keys, ids = keys[order], ids[order]
                if not len(keys):
                    continue
                held = _unpacked(batch.column(6)[a].as_py())
                place = np.searchsorted(keys, held)
                place[place == len(keys)] = 0
                met = keys[place] == held
                if met.any():
                    yield int(blocks[a]), REPLY, None, _packed(held[met]), pack(ids[place[met]])
    yield from record_batches(rows(), _ROWS)


def answers(pairs: DataFrame, frequent: DataFrame, salts: int) -> DataFrame:
    """Replies to the blocks: the keys of their pairs that are ranked (bucket, key, id), and the ids."""
    none = lambda t: F.lit(None).cast(t)
    asked = pairs.select("bucket", F.pmod("block", F.lit(salts)).cast("int").alias("salt"), F.lit(PAIRS).alias("kind"), "block",
                         F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("id"), "a")
    known = frequent.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(REPLY).alias("kind"),
                            F.lit(0).cast("long").alias("block"), "key", "id", none("binary").alias("a"))
    both = asked.unionByName(known).repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "kind")
    return map_arrow(both, _answer, _ROWS_DDL)


# --- phrases ----------------------------------------------------------------------------------------------------------

def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
            block_words: int = BLOCK, merge: int = MERGE, dense: int = DENSE) -> tuple[DataFrame, DataFrame]:
    """(phrases: lang, phrase, length, f of every phrase of 1 to ``longest`` words that occurs ``least`` times or more;
    totals: lang, n of all word occurrences)."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    path = new_path(spark, "collocation-blocks")
    map_arrow(rows, _cut(block_words), _CUT_DDL).write.option("compression", "zstd").partitionBy("kind").parquet(path)
    cut = spark.read.schema(_CUT_DDL).parquet(path)
    words, sequences = cut.filter(F.col("kind") == WORD), cut.filter(F.col("kind") == SEQUENCE)
    totals = staged(words.groupBy("lang").agg(F.sum("n").alias("n")), "collocation-totals")
    # A word has a row per block at most, so no word is a hot key of this window.
    of_word = Window.partitionBy("lang", "data")
    known = staged(words.select("block", "place", "lang", F.col("data").cast("string").alias("phrase"), F.sum("n").over(of_word).alias("f"))
                   .filter(F.col("f") >= least), "collocation-words")
    level = staged(ranked(known.groupBy("lang", "phrase").agg(F.max("f").alias("f")), "words", "lang", F.desc("f"), "phrase"), "collocation-words")
    first, found = level, [level.select("lang", "phrase", F.lit(1).alias("length"), "f")]

    size = sequences.agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("words")).first()
    buckets = 4 * partitions
    salts = max(1, -(-size["blocks"] // merge))
    parts = max(1, -(-(size["words"] or 0) // (HELD * buckets)))
    of = level.select(F.col("lang").alias("of_lang"), F.col("phrase").alias("of_phrase"), "id")
    numbered = known.join(of, (F.col("lang") == F.col("of_lang")) & (F.col("phrase") == F.col("of_phrase"))).select(
        "block", F.lit(WORD).alias("kind"), "place", "id", F.lit(None).cast("binary").alias("data"))
    both = numbered.unionByName(sequences.select("block", "kind", "place", F.lit(0).cast("long").alias("id"), "data"))
    rounds = map_arrow(both.repartition("block").sortWithinPartitions("block", "kind", "place"), _first_round(buckets), _ROWS_DDL)
    for length in range(2, longest + 1):
        path = new_path(spark, "collocation-round")
        rounds.write.option("compression", "zstd").partitionBy("kind").parquet(path)
        held = spark.read.schema(_ROWS_DDL).parquet(path)
        pairs = held.filter(F.col("kind") == PAIRS)
        frequent = staged(ranked(sums(pairs, least, salts, parts, dense), "phrases", F.desc("f"), "key"), "collocation-pairs")
        cell = lambda high, low: F.shiftleft(F.shiftright("key", high).bitwiseAND(F.lit((1 << 21) - 1)), BITS).bitwiseOR(
            F.shiftright("key", low).bitwiseAND(F.lit(_LOW)))
        split = frequent.select("id", "f", cell(41, BITS).alias("i"), cell(20, 0).alias("j"))
        before = level.select(F.col("id").alias("before_id"), "lang", F.col("phrase").alias("before"))
        behind = first.select(F.col("id").alias("behind_id"), F.col("phrase").alias("behind"))
        level = staged(split.join(before, F.col("i") == F.col("before_id")).join(behind, F.col("j") == F.col("behind_id")).select(
            "lang", F.concat("before", F.lit(" "), "behind").alias("phrase"), "f", "id"), "collocation-phrases")
        found.append(level.select("lang", "phrase", F.lit(length).alias("length"), "f"))
        if length < longest:
            state = held.filter(F.col("kind") == STATE).select("block", "kind", "a", "b")
            told = answers(pairs, frequent, salts).select("block", "kind", "a", "b").unionByName(state)
            rounds = map_arrow(told.repartition("block").sortWithinPartitions("block", "kind"), _next_round(length, buckets, length == longest - 1), _ROWS_DDL)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every, totals


def _exact(column, digits: int = 20):
    return column.cast(f"decimal({digits},0)")


def scored(every: DataFrame) -> DataFrame:
    """lang, phrase, length, a, l, r, score of the phrases of two words or more: their lowest-scoring cut, the first of equal ones."""
    cut = every.filter(F.col("length") > 1).select(
        "lang", "phrase", "length", F.col("f").alias("a"), F.split("phrase", " ").alias("w"), F.explode(F.expr("sequence(1, length - 1)")).alias("k"))
    cut = cut.select("lang", "phrase", "length", "a", "k", F.concat_ws(" ", F.expr("slice(w, 1, k)")).alias("head"),
                     F.concat_ws(" ", F.expr("slice(w, k + 1, length - k)")).alias("tail"))
    part = lambda name, f: every.select(F.col("lang").alias(f"{name}_lang"), F.col("phrase").alias(f"{name}_phrase"), F.col("f").alias(f))
    joined = cut.join(part("head", "l"), (F.col("lang") == F.col("head_lang")) & (F.col("head") == F.col("head_phrase"))).join(
        part("tail", "r"), (F.col("lang") == F.col("tail_lang")) & (F.col("tail") == F.col("tail_phrase")))
    product = F.lit(2_000_000).cast("decimal(7,0)") * _exact(F.col("a"))
    exact = joined.select("*", product.alias("above"), (_exact(F.col("l")) + _exact(F.col("r"))).alias("below"))
    exact = exact.withColumn("score", F.expr("above div below"))
    best = exact.groupBy("lang", "phrase", "length", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "length", "a", "cut.l", "cut.r", "cut.score")


def absorbed(every: DataFrame) -> DataFrame:
    """inner_lang, inner, most: the largest count of a longer phrase around each phrase of two words or more."""
    longer = every.filter(F.col("length") > 2).select(
        "lang", "length", "f", F.split("phrase", " ").alias("w"), F.explode(F.expr("sequence(2, length - 1)")).alias("size"))
    inner = longer.select("lang", "f", F.explode(F.expr("transform(sequence(1, length - size + 1), s -> concat_ws(' ', slice(w, s, size)))")).alias("inner"))
    return inner.groupBy(F.col("lang").alias("inner_lang"), "inner").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, top: int = TOP, share: int = SHARE, **settings) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    every, totals = phrases(docs, **settings)
    around = absorbed(every)
    found = scored(every).join(around, (F.col("lang") == F.col("inner_lang")) & (F.col("phrase") == F.col("inner")), "left")
    found = found.filter(F.col("most").isNull() | (100 * _exact(F.col("most")) < share * _exact(F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    n = totals.select(F.col("lang").alias("of_lang"), "n")
    return best.join(n, F.col("lang") == F.col("of_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
