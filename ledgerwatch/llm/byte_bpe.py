"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Encoding.  Texts are split into pre-tokens, the matches of the public pattern.
A task numbers the distinct pre-tokens of a block of texts and keeps the texts
as sequences of those numbers, so a pre-token's positions travel as integers.
The distinct pre-tokens of all blocks are shuffled by the word's hash, packed
into one row per block and hash bucket.  A bucket makes them distinct over the
whole input, encodes each once and sends its ids back to every block that holds
it; texts are reassembled by position.  A word as frequent as "the" travels once
per block, and every bucket gets at most one row per block, so there is no hot key.

Decoding.  The distinct ids of a block of id sequences meet the table of token
bytes in a join; sequences are reassembled by position as bytes.  The table is a
vocabulary, checked to hold at most ``MAX_TOKENS`` entries, so it is broadcast
and id sequences are not shuffled.

A pre-token is merged pair by pair, the pair of the lowest rank first and the
leftmost of equal ones, until no pair has a rank.  Special tokens are not known:
their strings are ordinary text.

Defined cases: a null or empty text has no ids and decodes to no bytes; ids may
be null and rows may repeat, every row is encoded as its own; empty tables give
no rows; a text of any length is a block of its own at most; other columns are
not read, whatever their names.  An id without an entry in the table raises.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .blocks import pack, pack_strings, record_batches, unpack, unpack_strings
from .common import byte_rows, map_arrow, ragged

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: A block is closed once its texts (of ids: its sequences) hold this many bytes; a bucket remembers words up to a bound in bytes.
BLOCK, ID_BLOCK, HELD = 16 << 20, 4 << 20, 64 << 20
MOST_BUCKETS = 4096
#: Pre-tokens of more bytes are merged by a heap.
SHORT = 64
_NONE = 1 << 62
#: Bound of the table of token bytes, which is broadcast (public vocabularies hold 50,000 to 260,000 entries).
MAX_TOKENS = 1 << 20

#: Pre-tokens never go on from a character that is no white space to one that is: texts fall into such chunks first.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNKS = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")


def public_vocabulary(name: str = VOCABULARY) -> tuple[dict[bytes, int], str]:
    """Ranks and split pattern of an installed public vocabulary."""
    import public_tokenizers

    return read_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing or len(ranks) > MAX_TOKENS:
        raise ValueError(f"a vocabulary holds all single bytes and at most {MAX_TOKENS} tokens: {len(ranks)} tokens, bytes {missing[:5]} missing")
    return ranks


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > SHORT:
        return _merged_long(piece, ranks)
    parts = [piece[k:k + 1] for k in range(len(piece))]
    pairs = [ranks.get(piece[k:k + 2], _NONE) for k in range(len(piece) - 1)]
    while pairs:
        least = min(pairs)
        if least == _NONE:
            break
        k = pairs.index(least)
        parts[k] += parts.pop(k + 1)
        del pairs[k]
        if k < len(pairs):
            pairs[k] = ranks.get(parts[k] + parts[k + 1], _NONE)
        if k:
            pairs[k - 1] = ranks.get(parts[k - 1] + parts[k], _NONE)
    return [ranks[p] for p in parts]


def _merged_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with the pairs in a heap: time in proportion to n log n."""
    n = len(piece)
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts here; 0: merged into another
    heap = [(r, k) for k in range(n - 1) if (r := ranks.get(piece[k:k + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, at = heapq.heappop(heap)
        middle = ends[at]
        if not middle or middle >= n or ranks.get(piece[at:ends[middle]]) != rank:
            continue  # a pair that is no more
        end = ends[at] = ends[middle]
        ends[middle] = 0
        if end < n:
            before[end] = at
            if (r := ranks.get(piece[at:ends[end]])) is not None:
                heapq.heappush(heap, (r, at))
        if before[at] >= 0 and (r := ranks.get(piece[before[at]:end])) is not None:
            heapq.heappush(heap, (r, before[at]))
    return [ranks[piece[k:ends[k]]] for k in range(n) if ends[k]]


# --- encoding ---------------------------------------------------------------------------------------------------------

_CUT = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("places", pa.binary()), ("lengths", pa.binary()),
                  ("data", pa.binary()), ("doc_ids", pa.list_(pa.int64()))])
_CUT_DDL = "block long, kind int, bucket long, places binary, lengths binary, data binary, doc_ids array<long>"
WORDS, TEXTS = 0, 1


def _cut(pattern: str, max_bytes: int, buckets: int):
    """A block's distinct pre-tokens, a row per bucket (places: their numbers), and a row of its texts (data: the numbers in order)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split = regex.compile(pattern).findall
        block = TaskContext.get().partitionId() << 32
        chunk_numbers: dict[str, int] = {}
        doc_ids: list[int | None] = []
        texts: list[np.ndarray] = []

        def rows():
            numbers: dict[str, int] = {}
            of_chunks: list[int] = []
            counts = np.zeros(len(chunk_numbers), np.int64)
            for k, chunk in enumerate(chunk_numbers):
                found = split(chunk)
                counts[k] = len(found)
                for word in set(found).difference(numbers):
                    numbers[word] = len(numbers)
                of_chunks.extend(map(numbers.__getitem__, found))
            flat, first = np.array(of_chunks, np.int32), np.cumsum(counts) - counts
            for k, chunks in enumerate(texts):  # one at a time: the places in between take several times a text's numbers
                texts[k] = flat[ragged(first[chunks], counts[chunks])]
            lengths, sequence = np.fromiter(map(len, texts), np.int64, len(texts)), np.concatenate(texts)
            texts.clear()
            chunk_numbers.clear()
            words, count = list(numbers), np.bincount(sequence, minlength=len(numbers)).tolist()
            often = sorted(range(len(words)), key=lambda k: (-count[k], words[k]))  # frequent ones get small numbers, a block always the same
            rank = np.empty(len(often), np.int32)
            rank[often] = np.arange(len(often))
            words = [words[k].encode() for k in often]
            bucket = np.fromiter(map(crc32, words), np.int64, len(words)) % buckets
            order = np.argsort(bucket, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(words) else ():
                yield (block, WORDS, int(bucket[part[0]]), pack(np.diff(part, prepend=0)), *pack_strings([words[k] for k in part.tolist()]), None)
            yield block, TEXTS, block, None, pack(lengths), pack(rank[sequence]), doc_ids

        size = 0
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1))):
                chunks = _CHUNKS.findall(data.decode("utf-8", "replace"))
                for chunk in set(chunks).difference(chunk_numbers):
                    chunk_numbers[chunk] = len(chunk_numbers)
                doc_ids.append(doc_id)
                texts.append(np.fromiter(map(chunk_numbers.__getitem__, chunks), np.int32, len(chunks)))
                size += len(data) + 64
                if size >= max_bytes:
                    yield from record_batches(rows(), _CUT)
                    chunk_numbers, doc_ids, texts, size, block = {}, [], [], 0, block + 1
        if texts:
            yield from record_batches(rows(), _CUT)
    return run


def _encode(shared, held: int):
    """Rows sorted by kind and bucket: each distinct pre-token of a bucket is encoded once, and every block gets the ids of its own.

    Rows of texts pass.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value

        def rows():
            now, memo, size = None, {}, 0
            for batch in batches:
                for block, kind, bucket, places, lengths, data, doc_ids in zip(*(batch.column(k).to_pylist() for k in range(7))):
                    if kind == TEXTS:
                        yield block, TEXTS, places, lengths, data, doc_ids
                        continue
                    if bucket != now or size > held:  # beyond the bound a bucket's words are encoded anew
                        now, memo, size = bucket, {}, 0
                    words = unpack_strings(lengths, data)
                    for word in set(words).difference(memo):
                        memo[word] = merged(word, ranks)
                        size += 200 + len(word) + 8 * len(memo[word])
                    found = [memo[w] for w in words]
                    yield (block, WORDS, places, pack(np.fromiter(map(len, found), np.int64, len(found))),
                           pack(np.fromiter(chain.from_iterable(found), np.int64)), None)
        yield from record_batches(rows(), _BACK)
    return run


_BACK = pa.schema([f for f in _CUT if f.name != "bucket"])
_BACK_DDL = "block long, kind int, places binary, lengths binary, data binary, doc_ids array<long>"


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, ids of words before the texts: a row of ids per text."""
    def rows():
        now, replies = None, []
        for batch in batches:
            for block, kind, places, lengths, data, doc_ids in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if block != now:
                    now, replies = block, []
                if kind == WORDS:
                    replies.append((np.cumsum(unpack(places).astype(np.int64)), unpack(lengths), unpack(data)))
                    continue
                numbers, texts = unpack(data), unpack(lengths).astype(np.int64)
                if replies:
                    place, counts, flat = (np.concatenate(x) for x in zip(*replies))
                    if len(place) != int(place.max()) + 1:
                        raise ValueError("words of a block without ids")
                    first, count = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
                    first[place], count[place] = np.cumsum(counts.astype(np.int64)) - counts, counts
                else:
                    first = count = flat = np.zeros(0, np.int64)
                replies = []
                stop = 0
                for doc_id, n in zip(doc_ids, texts.tolist()):
                    of = numbers[stop:stop + n]
                    stop += n
                    ids = flat[ragged(first[of], count[of])].astype("<u4")
                    yield doc_id, len(ids), ids.tobytes()

    yield from record_batches(rows(), _ENCODED)


_ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK, held: int = HELD) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids (unsigned 32-bit integers, little-endian).

    ``docs`` should be read from files: a task that is run again has to see its rows in the same order, or the job fails.
    """
    return map_arrow(_answered(docs, ranks, pattern, id_col, text_col, block_bytes, held), _assemble, "doc_id long, n_tokens long, ids binary")


def _answered(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str, text_col: str, block_bytes: int, held: int) -> DataFrame:
    """Rows sorted by block: the ids of its words, then its texts."""
    spark = docs.sparkSession
    buckets = min(MOST_BUCKETS, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = map_arrow(rows, _cut(pattern, block_bytes, buckets), _CUT_DDL)
    dealt = cut.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket")
    both = map_arrow(dealt, _encode(spark.sparkContext.broadcast(ranks), held), _BACK_DDL)
    return both.repartition("block").sortWithinPartitions("block", "kind")


# --- decoding ---------------------------------------------------------------------------------------------------------

_IDS_DDL = "block long, kind int, token long, doc_id long, ids binary"
_IDS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("token", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])


def token_bytes(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """The table of token bytes: id, bytes."""
    if len(ranks) > MAX_TOKENS:
        raise ValueError(f"a vocabulary of more than {MAX_TOKENS} tokens")
    return spark.createDataFrame([(r, b) for b, r in ranks.items()], "id long, bytes binary")


def _id_blocks(max_bytes: int):
    """Rows of distinct ids and of the sequences of every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            block, held, size = 0, [], 0

            def close():
                seen = np.zeros(0, bool)
                for _, ids in held:
                    tokens = np.frombuffer(ids, "<u4")
                    if len(tokens) and (most := int(tokens.max())) >= len(seen):
                        if most >= MAX_TOKENS:
                            raise ValueError(f"id {most} has no entry in the table of token bytes")
                        seen = np.concatenate([seen, np.zeros(most + 1 - len(seen), bool)])
                    seen[tokens] = True
                for token in np.flatnonzero(seen).tolist():
                    yield block, WORDS, token, None, None
                for doc_id, ids in held:
                    yield block, TEXTS, None, doc_id, ids

            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    held.append((doc_id, ids or b""))
                    size += len(ids or b"") + 64
                    if size >= max_bytes:
                        yield from close()
                        block, held, size = block + 1, [], 0
            if held:
                yield from close()
        yield from record_batches(rows(), _IDS)
    return run


def _assembled_blocks(max_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _id_blocks(max_bytes)(b.select(["doc_id", "ids"]) for b in _assemble(batches))
    return run


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, distinct ids with their bytes before the sequences: the bytes of each sequence."""
    def rows():
        block, tokens, data = None, [], []
        for batch in batches:
            for now, kind, token, doc_id, ids, of_token in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if now != block:
                    block, tokens, data = now, [], []
                if kind == WORDS:
                    if of_token is None:
                        raise ValueError(f"id {token} has no entry in the table of token bytes")
                    tokens.append(token)
                    data.append(of_token)
                    continue
                if data is not None:
                    places = np.array(tokens, np.int64)
                    first, count = (np.zeros(int(places.max()) + 1 if len(places) else 0, np.int64) for _ in range(2))
                    count[places] = np.fromiter(map(len, data), np.int64, len(data))
                    first[places] = np.cumsum(count[places]) - count[places]
                    flat, data = np.frombuffer(b"".join(data), np.uint8), None
                of = np.frombuffer(ids, "<u4")
                yield doc_id, ids, flat[ragged(first[of], count[of])].tobytes()
    yield from record_batches(rows(), _DECODED)


_DECODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def decode(encoded: DataFrame, table: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", block_bytes: int = ID_BLOCK) -> DataFrame:
    """One row per input row: doc_id, ids, decoded (bytes).  No shuffle."""
    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return _decoded(map_arrow(rows, _id_blocks(block_bytes), _IDS_DDL), table)


def _decoded(cut: DataFrame, table: DataFrame) -> DataFrame:
    """The rows of ``_id_blocks`` with the bytes of their tokens."""
    met = cut.join(F.broadcast(table.select(F.col("id").alias("of_id"), "bytes")), F.col("token") == F.col("of_id"), "left")
    ordered = met.select("block", "kind", "token", "doc_id", "ids", "bytes").sortWithinPartitions("block", "kind", "token")
    return map_arrow(ordered, _decode, "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``decode`` of ``encode``; the sequences pass from one to the other within a Python worker.
    """
    answered = _answered(docs, ranks, pattern, id_col, text_col, block_bytes, HELD)
    cut = map_arrow(answered, _assembled_blocks(min(block_bytes, ID_BLOCK)), _IDS_DDL)
    decoded = _decoded(cut, token_bytes(docs.sparkSession, ranks))
    return decoded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
