"""Blocks of numbered words: what several operators send through a shuffle instead of a row per word.

A task reads its texts into blocks of a bounded number of words.  A block holds
every distinct word once, numbered from 0, and the texts as sequences of those
numbers.  What is found out about a distinct word elsewhere is joined back by
word and put in place within the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard


def pack(values: np.ndarray) -> bytes:
    """32-bit integers by byte planes, compressed: small numbers leave whole planes of zeros."""
    return zstandard.compress(np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def unpack(data) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def pack64(values: np.ndarray) -> bytes:
    """64-bit integers by byte planes, compressed."""
    return zstandard.compress(np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 3)


def unpack64(data) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T).view("<i8").ravel()


def pack_strings(parts: list[bytes]) -> tuple[bytes, bytes]:
    """Byte strings as (lengths, bytes in a row)."""
    return pack(np.fromiter(map(len, parts), np.int64, len(parts))), zstandard.compress(b"".join(parts), 3)


def unpack_strings(lengths, data) -> list[bytes]:
    ends = np.cumsum(unpack(lengths).astype(np.int64)).tolist()
    whole = zstandard.decompress(data)
    return [whole[a:b] for a, b in zip([0, *ends], ends)]


def record_batches(rows: Iterator[tuple], schema: pa.Schema, max_bytes: int = 4 << 20, max_rows: int = 8192) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a bounded size; a longer row makes a batch of its own."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 32 + sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if len(held) >= max_rows or size >= max_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

