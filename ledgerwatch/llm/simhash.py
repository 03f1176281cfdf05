"""SimHash near-duplicates by tiled exact comparison.

A text is lower-cased (A-Z), cut into words at white space and into shingles of
``shingle`` words; each shingle's XXH64 votes on 64 bits.  Distinct fingerprints
fall into cells by the population counts of their four 16-bit quarters.  Two
fingerprints within the radius differ by at most the radius in the sum of their
quarters' counts, so tile pairs of cells further apart are skipped; the others
are compared whole, by numpy exclusive-or and bit counts.

Cells are cut into tiles of about ``TILE`` fingerprints.  Each tile is packed
into one binary value and sent to the tiles of the neighbouring cells that come
before it, so a pair of tiles meets once and shipped bytes grow with the number
of distinct fingerprints (65 copies of 8 bytes at radius 3), whatever the skew.
A tile comparison that finds more links than it has fingerprints reports a
spanning forest of them, so a dense group never emits all its pairs.

Defined cases: null and blank texts have fingerprint zero and link like any
other; texts shorter than a shingle have one shingle, the whole word sequence;
equal fingerprints are one node; a component takes the smallest id in it (null
only if all its ids are null); an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import byte_rows, map_arrow, staged
from .components import components

SEED = 42
TILE = 4096
#: Fingerprints of a tile that are compared with others at a time.
BLOCK = 128
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles; a bit is set if over half the hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = words[at:min(at + CHUNK, n) + shingle - 1]
        if len(part) < shingle:
            hashes = [xxhash.xxh64_intdigest(b" ".join(part), SEED)]
        else:
            digest = xxhash.xxh64_intdigest
            hashes = [digest(s, SEED) for s in map(b" ".join, zip(*(part[i:] for i in range(shingle))))]
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in byte_rows(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fp"])
    return run


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long)."""
    return map_arrow(df.select(F.col(id_col).cast("long"), F.col(text_col)), _fingerprints(shingle), "doc_id long, fp long")


def _neighbours(radius: int) -> list[tuple[int, ...]]:
    """Steps to the cells within ``radius`` that come at or before a cell."""
    steps = [s for s in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, s)) <= radius]
    return [s for s in steps if s <= (0, 0, 0, 0)]


def _cell(q: np.ndarray) -> np.ndarray:
    return ((q[:, 0] * 17 + q[:, 1]) * 17 + q[:, 2]) * 17 + q[:, 3]


_SENT = pa.schema([("cell", pa.int32()), ("tile", pa.int32()), ("from_cell", pa.int32()), ("from_tile", pa.int32()), ("block", pa.binary())])
_SENT_DDL = "cell int, tile int, from_cell int, from_tile int, block binary"


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of sorted batches within which the first ``keys`` columns do not change."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield tuple(int(c[a]) for c in cols), batch.slice(a, b - a)


def _pack(radius: int, tiles: dict[int, int]):
    """Rows (cell, tile, fp) sorted by cell and tile: blocks for every tile they must meet."""
    steps = _neighbours(radius)

    def send(cell: int, tile: int, fps: np.ndarray):
        at = (cell // 4913, cell // 289 % 17, cell // 17 % 17, cell % 17)
        block = fps.tobytes()
        for step in steps:
            to = [a + s for a, s in zip(at, step)]
            if min(to) < 0 or max(to) > 16:
                continue
            other = ((to[0] * 17 + to[1]) * 17 + to[2]) * 17 + to[3]
            n = tiles.get(other, 0)
            for t in range(n if other != cell else tile + 1):  # of its own cell only tiles up to itself
                yield other, t, cell, tile, block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, out, size = [], None, [], 0

        def flush():
            nonlocal out, size
            for row in send(*key, np.concatenate(held)) if held else ():
                out.append(row)
                size += len(row[4]) + 40
                if size > 4 << 20:
                    yield _sent(out)
                    out, size = [], 0

        for now, part in _runs(batches, 2):
            if now != key:
                yield from flush()
                held, key = [], now
            held.append(part.column(2).to_numpy())
        yield from flush()
        if out:
            yield _sent(out)
    return run


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SENT.types)], schema=_SENT)


def links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i in a, j in b) of fingerprints at most ``radius`` bits apart."""
    rows, cols = [], []
    for at in range(0, len(a), BLOCK):
        far = np.bitwise_count(a[at:at + BLOCK, None] ^ b[None, :])
        i, j = np.nonzero(far <= radius)
        if len(i):
            rows.append(i + at)
            cols.append(j)
    empty = np.zeros(0, np.int64)
    return (np.concatenate(rows), np.concatenate(cols)) if rows else (empty, empty)


def forest(u: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewer edges, at most n - 1, with the components of edges (u, v) over places 0..n-1."""
    label = np.arange(n)
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            break
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def _compare(radius: int):
    """Blocks sorted by tile, its own block first: links of each block with the tile."""
    def met(home: np.ndarray, others: list[np.ndarray], own: bool) -> tuple[np.ndarray, np.ndarray]:
        other = np.concatenate(others)
        i, j = links(home, other, radius)
        if own:
            i, j = i[i < j], j[i < j]
        if len(i) > len(home) + len(other):
            nodes = home if own else np.concatenate([home, other])
            i, j = forest(i, j if own else j + len(home), len(nodes))
            return nodes[i], nodes[j]
        return home[i], other[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home, held, size = None, None, [], 0
        for batch in batches:
            cells, tiles, fc, ft = (batch.column(i).to_pylist() for i in range(4))
            for cell, tile, from_cell, from_tile, block in zip(cells, tiles, fc, ft, batch.column(4).to_pylist()):
                fps = np.frombuffer(block, np.uint64)
                if (cell, tile) != key:
                    if held:
                        yield _edges(*met(home, held, False))
                    key, home, held, size = (cell, tile), fps, [], 0
                    assert (from_cell, from_tile) == key, "a tile's own block comes first"
                    yield _edges(*met(home, [home], True))
                    continue
                held.append(fps)
                size += len(fps)
                if size >= TILE:
                    yield _edges(*met(home, held, False))
                    held, size = [], 0
        if held:
            yield _edges(*met(home, held, False))
    return run


def _edges(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])


def link_edges(distinct: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """Edges (u, v) that connect all fingerprints ``fp`` within ``radius`` bits of each other.

    The driver holds a count per cell: at most 17^4 = 83,521 integers.
    """
    quarter = lambda k: F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFF << 16 * k if k < 3 else -(1 << 48))))
    cells = distinct.select("fp", (((quarter(0) * 17 + quarter(1)) * 17 + quarter(2)) * 17 + quarter(3)).cast("int").alias("cell"))
    counts = {r["cell"]: r["n"] for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    tiles = {c: -(-n // tile) for c, n in counts.items()}
    number = distinct.sparkSession.createDataFrame(list(tiles.items()), "of_cell int, n int")  # a row per cell
    tiled = cells.join(F.broadcast(number), F.col("cell") == F.col("of_cell")).select(
        "cell", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int").alias("tile"), "fp")
    tiled = tiled.repartition("cell", "tile").sortWithinPartitions("cell", "tile")
    shipped = map_arrow(tiled, _pack(radius, tiles), _SENT_DDL)
    home_first = F.when((F.col("cell") == F.col("from_cell")) & (F.col("tile") == F.col("from_tile")), 0).otherwise(1)
    met = shipped.withColumn("late", home_first).repartition("cell", "tile").sortWithinPartitions("cell", "tile", "late")
    return map_arrow(met.drop("late"), _compare(radius), "u long, v long")


def components_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3,
                  tile: int = TILE) -> DataFrame:
    """One row per input row: doc_id, fp (long), component_id."""
    docs = staged(fingerprints(df, id_col, text_col, shingle), "simhash")
    nodes = staged(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    roots = components(link_edges(nodes.select("fp"), radius, tile))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id")).withColumnRenamed("root", "least_root")
    labels = rooted.join(least, F.col("root") == F.col("least_root")).select(F.col("fp").alias("label_fp"), "component_id")
    return docs.join(labels, F.col("fp") == F.col("label_fp")).select("doc_id", "fp", "component_id")


def survivors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``df`` whose id is its component's id, whole; rows without an id stay."""
    found = components_of(df.filter(F.col(id_col).isNotNull()), id_col, text_col, shingle, radius)
    drop = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__simhash_drop"))
    key = df[id_col].cast("long") == F.col("__simhash_drop")
    return df.join(drop.distinct(), key, "left_anti").select(*df.columns)
