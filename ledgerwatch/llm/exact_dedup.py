"""Exact deduplication with Patricia-trie owners.

Texts are equal when identical after deleting white space (space, tab, LF, VT,
FF, CR).  Of equal texts the owner is the row with the most code points in the
original text, then the smallest id.

Every input partition inserts its normalised byte strings into compressed radix
tries, one subtree per (length, content hash); a terminal node holds the best
owner and a count.  Subtrees leave memory as partial owners once the trie holds
``max_bytes`` (the largest first) and at the end.  Partial owners are shuffled
by (length, hash) and sorted, so the merging task inserts full byte strings of
one subtree at a time and releases it when the next begins: the external sort
holds what does not fit.  A text shared by a third of all rows reaches the
merge as one row per input partition (or spill), never as its copies.

Defined cases: a null text equals the empty text; a null id ranks behind every
id; rows that repeat an id with an equal text are one document, each marked
``kept`` if the id is kept (``survivors`` returns a single row); an empty table
gives no rows; other columns are not read by ``owners`` and pass through
``survivors`` whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import byte_rows, map_arrow

WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
MAX_BYTES = 32 << 20
#: Prefix of the helper columns.
_P = "__exact_dedup_"


class Node:
    """An edge label, children by first byte, and the owner of the string that ends here."""

    __slots__ = ("edge", "children", "owner")

    def __init__(self, edge: bytes, owner=None):
        self.edge, self.children, self.owner = edge, None, owner


class PatriciaTrie:
    """A compressed radix trie over byte strings; ``[rank, id, n]`` at terminal nodes."""

    def __init__(self):
        self.root = Node(b"")
        self.bytes = 0

    def insert(self, key: bytes, rank: tuple, n: int = 1) -> bool:
        """Insert ``key``; True if it is new or ``rank`` beats the owner's (smaller is better)."""
        node, at = self.root, 0
        while True:
            if at == len(key):
                return self._own(node, rank, n)
            child = node.children.get(key[at]) if node.children else None
            if child is None:
                if node.children is None:
                    node.children = {}
                node.children[key[at]] = Node(key[at:], [rank, n])
                self.bytes += len(key) - at + 200
                return True
            edge = child.edge
            if key.startswith(edge, at):
                node, at = child, at + len(edge)
                continue
            same = _common(edge, key, at)
            upper = Node(edge[:same])
            upper.children = {edge[same]: child}
            child.edge = edge[same:]
            node.children[key[at]] = upper
            node, at = upper, at + same

    def _own(self, node: Node, rank: tuple, n: int) -> bool:
        if node.owner is None:
            node.owner = [rank, n]
            return True
        better = rank < node.owner[0]
        if better:
            node.owner[0] = rank
        node.owner[1] += n
        return better

    def items(self) -> Iterator[tuple[bytes, tuple, int]]:
        stack = [(self.root, b"")]
        while stack:
            node, prefix = stack.pop()
            prefix += node.edge
            if node.owner is not None:
                yield prefix, node.owner[0], node.owner[1]
            for child in (node.children or {}).values():
                stack.append((child, prefix))


def _common(edge: bytes, key: bytes, at: int) -> int:
    """Length of the shared prefix of ``edge`` and ``key[at:]``, by halving."""
    low, high = 0, min(len(edge), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if edge[low:mid] == key[at + low:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class OwnerTrie:
    """Subtrees by (length, hash); the largest leave first once ``max_bytes`` are held."""

    def __init__(self, max_bytes: int):
        self.max_bytes, self.held = max_bytes, 0
        self.subtrees: dict[tuple[int, int], PatriciaTrie] = {}
        self.largest: list[tuple[int, tuple[int, int]]] = []

    def insert(self, part: tuple[int, int], key: bytes, rank: tuple, n: int = 1) -> bool:
        tree = self.subtrees.get(part)
        if tree is None:
            tree = self.subtrees[part] = PatriciaTrie()
            heapq.heappush(self.largest, (-len(key), part))
        before = tree.bytes
        new = tree.insert(key, rank, n)
        self.held += tree.bytes - before
        return new

    def spill(self, to: int | None = None) -> Iterator[tuple[tuple[int, int], bytes, tuple, int]]:
        """Release whole subtrees until ``to`` bytes are left (default: half of the bound)."""
        to = self.max_bytes // 2 if to is None else to
        while self.largest and self.held > to:
            yield from self.release(heapq.heappop(self.largest)[1])

    def release(self, part: tuple[int, int]) -> Iterator[tuple[tuple[int, int], bytes, tuple, int]]:
        tree = self.subtrees.pop(part)
        self.held -= tree.bytes
        for key, rank, n in tree.items():
            yield part, key, rank, n


def _rank(n_points: int, doc_id) -> tuple:
    return (-n_points, doc_id is None, 0 if doc_id is None else doc_id)


def normalised(text: bytes) -> bytes:
    return text.translate(None, WHITE)


def _points(text: bytes) -> int:
    """Code points of UTF-8 bytes: all bytes but continuation bytes."""
    return len(text) if text.isascii() else len(text.decode("utf-8", "replace"))


def _hash(key: bytes) -> int:
    return xxhash.xxh3_64_intdigest(key) - (1 << 63)


_OWNERS = pa.schema([("len", pa.int64()), ("hash", pa.int64()), ("key", pa.binary()),
                     ("points", pa.int64()), ("id", pa.int64()), ("n", pa.int64())])
_CLASSES = pa.schema([("text_sha256", pa.binary()), ("points", pa.int64()), ("id", pa.int64()), ("n", pa.int64())])


def _batches(rows: Iterator[tuple], schema: pa.Schema, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, bytes))
        if len(held) >= 8192 or size >= max_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _local_owners(max_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            trie = OwnerTrie(max_bytes)
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1))):
                    key = normalised(text)
                    trie.insert((len(key), _hash(key)), key, _rank(_points(text), doc_id))
                    if trie.held > max_bytes:
                        yield from out(trie.spill())
            yield from out(trie.spill(0))
            for part in list(trie.subtrees):  # the empty string takes no bytes
                yield from out(trie.release(part))

        def out(found):
            for (length, h), key, rank, n in found:
                yield length, h, key, -rank[0], None if rank[1] else rank[2], n

        yield from _batches(rows(), _OWNERS)
    return run


def _merge_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted partial owners: one subtree at a time."""
    def rows():
        tree, part = PatriciaTrie(), None
        for batch in batches:
            c = [batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5)]
            for length, h, points, doc_id, n, key in zip(*c, byte_rows(batch.column(2))):
                if (length, h) != part:
                    yield from out(tree)
                    tree, part = PatriciaTrie(), (length, h)
                tree.insert(key, _rank(points, doc_id), n)
        yield from out(tree)

    def out(tree):
        for key, rank, n in tree.items():
            yield hashlib.sha256(key).digest(), -rank[0], None if rank[1] else rank[2], n

    yield from _batches(rows(), _CLASSES)


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per distinct normalised text: ``text_sha256`` (binary), the owner's points and id, and ``n``."""
    local = map_arrow(df.select(F.col(id_col).cast("long"), F.col(text_col)),
                      _local_owners(max_bytes), "len long, hash long, key binary, points long, id long, n long")
    return map_arrow(local.repartition("len", "hash").sortWithinPartitions("len", "hash"),
                     _merge_owners, "text_sha256 binary, points long, id long, n long")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points, digests = [], []
        for text in byte_rows(batch.column(1)):
            points.append(_points(text))
            digests.append(hashlib.sha256(normalised(text)).digest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(points, pa.int64()), pa.array(digests, pa.binary())],
                                         names=["doc_id", "points", "sha"])


def owners(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The join back carries an id and a digest a row; a digest that a third of the
    rows share makes a skewed partition of the left side, which AQE splits.
    """
    ids = map_arrow(df.select(F.col(id_col).cast("long"), F.col(text_col)), _digests, "doc_id long, points long, sha binary")
    found = classes(df, id_col, text_col, max_bytes).select(
        F.col("text_sha256").alias("class_sha"), F.col("points").alias("keep_points"), F.col("id").alias("keep_id"), "n")
    joined = ids.join(found, ids["sha"] == found["class_sha"])
    return joined.select("doc_id", "keep_id", F.col("n").alias("group_size"),
                         (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))).alias("kept"),
                         F.lower(F.hex("sha")).alias("text_sha256"))


def _new_rows(max_bytes: int, id_at: int, text_at: int, keep: bool):
    """Pass on rows whose text is new to the trie or that beat its owner.

    ``keep`` True: the rows come sorted by (length, hash, rank), so the first of
    a text is its owner and a subtree can go when the next begins.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, part = OwnerTrie(max_bytes), None
        for batch in batches:
            take, parts, points = [], [], []
            for i, (doc_id, text) in enumerate(zip(batch.column(id_at).to_pylist(), byte_rows(batch.column(text_at)))):
                key, n = normalised(text), _points(text)
                at = (len(key), _hash(key))
                if keep and at != part:
                    trie, part = OwnerTrie(max_bytes), at
                if trie.insert(at, key, _rank(n, doc_id)):
                    take.append(i)
                    parts.append(at)
                    points.append(n)
                if trie.held > max_bytes and not keep:  # a forgotten subtree only lets rows through to the merge
                    for _ in trie.spill():
                        pass
            if not take:
                continue
            kept = batch.take(pa.array(take, pa.int32()))
            if keep:
                yield kept.select(list(range(kept.num_columns - 3)))
            else:
                extra = [pa.array([p[0] for p in parts], pa.int64()), pa.array([p[1] for p in parts], pa.int64()), pa.array(points, pa.int64())]
                yield pa.RecordBatch.from_arrays([*kept.columns, *extra], names=[*kept.schema.names, _P + "len", _P + "hash", _P + "points"])
    return run


def survivors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """The owner row of every distinct text, whole, with the input's columns."""
    id_at, text_at = df.columns.index(id_col), df.columns.index(text_col)
    columns = [f"c{i}" for i in range(len(df.columns))]  # by place: names may clash or hold any character
    by_place = df.toDF(*columns)
    fields = ", ".join(f"{c} {t}" for c, t in by_place.dtypes)
    local = map_arrow(by_place, _new_rows(max_bytes, id_at, text_at, False),
                      f"{fields}, {_P}len long, {_P}hash long, {_P}points long")
    order = (f"{_P}len", f"{_P}hash", F.desc(f"{_P}points"), F.asc_nulls_last(columns[id_at]))
    grouped = local.repartition(f"{_P}len", f"{_P}hash").sortWithinPartitions(*order)
    return map_arrow(grouped, _new_rows(max_bytes, id_at, text_at, True), fields).toDF(*df.columns)
