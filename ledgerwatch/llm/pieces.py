"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

A piece model gives pieces and scores; the scores are used as log scores of a
unigram model whatever the model's own type.  White space (U+0020) becomes the
marker U+2581, one marker is put in front, and the best-scored segmentation is
found by Viterbi over a double-array trie of the pieces' UTF-8 bytes.  A
character that no piece covers costs the smallest score less 10 and is written
as byte pieces.  Of equally good segmentations the one whose last pieces start
earliest wins.

No piece holds a marker behind another character and none holds a character
that is unknown to all pieces, so the best segmentation of a text is that of
its words, one after the other.  Words are remembered per task (bounded), hence
the cost is a lookup per word and a Viterbi per distinct word.

The piece file is read on the driver, its tables (a few MB, fixed by the
vocabulary) are broadcast.

Defined cases: null and empty texts have no ids and decode to the empty text;
a literal U+2581 decodes as a space (``round_trip`` is then false); ids outside
the vocabulary and null ids decode to nothing; broken byte sequences decode to
U+FFFD; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import byte_rows, map_arrow, ragged

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words, and bytes of words, remembered by a task; words searched at a time; longer words (in bytes) are searched alone.
MEMO, MEMO_BYTES, WORDS_AT_ONCE, LONG_WORD = 1 << 18, 16 << 20, 1 << 13, 64
#: Text bytes (or ids) handled at a time.
BYTES_AT_ONCE = 1 << 20

#: Fixed values of the piece model's file format: piece types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        else:
            size = {1: 8, 5: 4}[kind]
            value, at = data[at:at + size], at + size
        yield key >> 3, value


def read_pieces(data: bytes) -> list[tuple[str, float, int]]:
    """(piece, score, type) by id."""
    found = []
    for number, message in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for k, v in _fields(message):
                if k == 1:
                    piece = v.decode("utf-8")
                elif k == 2:
                    score = struct.unpack("<f", v)[0]
                elif k == 3:
                    kind = v
            found.append((piece, score, kind))
    return found


#: Places of the double array that are tried at a time.
_SEARCH = 2048


def double_array(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value arrays of a trie over byte strings; state 0 is the root, a byte b leads to base + b + 1."""
    children: list[dict[int, int]] = [{}]
    values = [-1]
    for key, value in keys:
        node = 0
        for byte in key:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                values.append(-1)
            node = children[node][byte]
        values[node] = value
    size = 4 * len(children) + 2 * _SEARCH + 1024
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    free = np.ones(size, bool)
    free[0] = False
    low = top = 0
    state, order = {0: 0}, [0]
    for node in order:
        at = state[node]
        value[at] = values[node]
        if not children[node]:
            continue
        labels = [byte + 1 for byte in sorted(children[node])]
        start = low
        while True:  # the first place where all labels fall on free cells, a stretch of places at a time
            fits = free[start + labels[0]:start + labels[0] + _SEARCH].copy()
            for label in labels[1:]:
                fits &= free[start + label:start + label + _SEARCH]
            first = int(fits.argmax())
            if fits[first]:
                start += first
                break
            start += _SEARCH
        low = max(low, start - _SEARCH)  # nearly full cells further back are given up
        base[at] = start
        for byte, child in sorted(children[node].items()):
            to = start + byte + 1
            free[to], check[to], state[child] = False, at, to
            order.append(child)
        top = max(top, start + 257)
        if top + 2 * _SEARCH + 514 > size:
            base, check, value, free = (np.append(x, np.full(size, fill, x.dtype)) for x, fill in ((base, 0), (check, -1), (value, -1), (free, True)))
            size *= 2
    return base[:top + 1], check[:top + 1], value[:top + 1]


class Tables:
    """What encoding and decoding need; plain lists are the fastest to index."""

    def __init__(self, model: bytes):
        pieces = read_pieces(model)
        self.bytes = [0] * 256
        keys, self.out, scores = [], [], []
        for i, (piece, score, kind) in enumerate(pieces):
            scores.append(score)
            if kind == BYTE:
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                self.out.append(bytes([value]))
            elif kind in (NORMAL, USER):
                keys.append((piece.encode("utf-8"), i))
                self.out.append(piece.replace(MARK, " ").encode("utf-8"))
            else:
                self.out.append(b"")
        self.n_control = sum(kind in (UNKNOWN, CONTROL) for _, _, kind in pieces)
        self.byte_ids = frozenset(self.bytes)
        self.unknown = min((s for s, (_, _, kind) in zip(scores, pieces) if kind == NORMAL), default=0.0) - UNKNOWN_PENALTY
        base, check, value = double_array(keys)
        self.base, self.check, self.value, self.scores = base.tolist(), check.tolist(), value.tolist(), scores

    @classmethod
    def of(cls, values: dict) -> Tables:
        """Tables from their plain values, which is what is broadcast."""
        tables = cls.__new__(cls)
        tables.__dict__.update(values)
        return tables

    def viterbi(self, word: bytes) -> tuple[int, ...]:
        """Ids of the best segmentation of one word (markers in place)."""
        base, check, value, scores = self.base, self.check, self.value, self.scores
        n, states = len(word), len(check)
        best: list = [None] * (n + 1)
        best[0] = 0.0
        start: list[int] = [0] * (n + 1)
        piece: list[int] = [-1] * (n + 1)
        i = 0
        while i < n:
            lead = word[i]
            step = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            so_far = best[i]
            state, j, single = 0, i, False
            while j < n:
                to = base[state] + word[j] + 1
                if to >= states or check[to] != state:
                    break
                state = to
                j += 1
                found = value[state]
                if found >= 0:
                    score = so_far + scores[found]
                    if best[j] is None or score > best[j]:
                        best[j], start[j], piece[j] = score, i, found
                    single = single or j == i + step
            if not single:
                j = min(i + step, n)
                score = so_far + self.unknown
                if best[j] is None or score > best[j]:
                    best[j], start[j], piece[j] = score, i, -1
            i += step
        ids: list[int] = []
        at = n
        while at > 0:
            i = start[at]
            ids.extend([piece[at]] if piece[at] >= 0 else [self.bytes[b] for b in reversed(word[i:at])])
            at = i
        return tuple(reversed(ids))


#: A word with the spaces before it; a line feed, unknown to most models, stands alone if it is unknown.
_WORDS = re.compile(r" *[^ ]+| +")
_WORDS_LF = re.compile(r"\n| *[^ \n]+| +")


class Encoder:
    """Encodes texts in bulk; remembers where the ids of a word lie."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.base, self.check, self.value = (np.array(x, np.int32) for x in (tables.base, tables.check, tables.value))
        self.scores = np.array(tables.scores)
        self.words = _WORDS_LF if not any(b"\n" in p and len(p) > 1 for p in tables.out) else _WORDS
        self.clear()

    def clear(self):
        self.place: dict[str, int] = {}
        self.first, self.count, self.flat, self.n, self.held = [], [], [], 0, 0

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the offsets of the texts in it."""
        found = [self.words.findall(" " + t.decode("utf-8", "replace")) if t else [] for t in texts]
        if len(self.place) > MEMO or self.held > MEMO_BYTES:
            self.clear()
        place = self.place
        new = set(chain.from_iterable(found)).difference(place)
        if new:
            self.learn(list(new))
        at = np.fromiter(map(place.__getitem__, chain.from_iterable(found)), np.int64, sum(map(len, found)))
        first, self.first = np.concatenate(self.first or [at]), [np.concatenate(self.first or [at])]
        count, self.count = np.concatenate(self.count or [at]), [np.concatenate(self.count or [at])]
        flat, self.flat = np.concatenate(self.flat or [at]), [np.concatenate(self.flat or [at])]
        ids = flat[ragged(first[at], count[at])].astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(count[at])])
        return ids, ends[np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)]

    def learn(self, words: list[str]):
        data = [w.replace(" ", MARK).encode("utf-8") for w in words]
        self.held += sum(map(len, data))
        order = sorted(range(len(words)), key=lambda k: len(data[k]))
        for a in range(0, len(order), WORDS_AT_ONCE):
            part = order[a:a + WORDS_AT_ONCE]
            short = [k for k in part if len(data[k]) <= LONG_WORD]
            for members, (count, flat) in ((short, self.bulk([data[k] for k in short])),
                                           (part[len(short):], self.one_by_one([data[k] for k in part[len(short):]]))):
                for k in members:
                    self.place[words[k]] = len(self.place)
                self.first.append(self.n + np.cumsum(count) - count)
                self.count.append(count)
                self.flat.append(flat)
                self.n += int(count.sum())

    def one_by_one(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.tables.viterbi(w) for w in words]
        return np.array([len(x) for x in found], np.int64), np.array(list(chain.from_iterable(found)), np.int32)

    def bulk(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The Viterbi search for many words at a time, one byte position after the other."""
        n = np.array([len(w) for w in words], np.int64)
        if not len(n):
            return n, np.zeros(0, np.int32)
        width = int(n.max())
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width).T.astype(np.int32)
        text = np.ascontiguousarray(text)
        best = np.full((width + 5, len(n)), -np.inf)
        start, piece = np.zeros(best.shape, np.int32), np.full(best.shape, -1, np.int32)
        best[0] = 0
        for i in range(width):
            rows = np.flatnonzero((best[i] > -np.inf) & (n > i))
            if not len(rows):
                continue
            so_far, lead = best[i, rows], text[i, rows]
            step = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
            covered = np.zeros(len(rows), bool)
            live, state = np.arange(len(rows)), np.zeros(len(rows), np.int32)
            for j in range(i, width):
                to = np.minimum(self.base[state] + text[j, rows[live]] + 1, len(self.check) - 1)
                goes = (self.check[to] == state) & (n[rows[live]] > j)
                live, state = live[goes], to[goes]
                if not len(live):
                    break
                found = self.value[state]
                ends = found >= 0
                who, what = live[ends], found[ends]
                covered[who[step[who] == j + 1 - i]] = True
                self.better(best, start, piece, j + 1, rows[who], so_far[who] + self.scores[what], i, what)
            bare = np.flatnonzero(~covered)
            for width_of in np.unique(step[bare]).tolist():
                who = bare[step[bare] == width_of]
                self.better(best, start, piece, i + width_of, rows[who], so_far[who] + self.tables.unknown, i, np.full(len(who), -1, np.int32))
        paths, at = [], n.copy()
        unknown = np.zeros(len(n), bool)
        while (at > 0).any():
            on = at > 0
            found = np.where(on, piece[at, np.arange(len(n))], -2)
            unknown |= found == -1
            paths.append(found)
            at = np.where(on, start[at, np.arange(len(n))], 0)
        steps = np.stack(paths[::-1], axis=1)  # the last step of each word in the last column
        count = (steps != -2).sum(axis=1)
        if not unknown.any():
            return count, steps[steps != -2].astype(np.int32)
        lists = [self.tables.viterbi(w) if u else s[s != -2].tolist() for w, u, s in zip(words, unknown, steps)]
        return np.array([len(x) for x in lists], np.int64), np.array(list(chain.from_iterable(lists)), np.int32)

    @staticmethod
    def better(best, start, piece, at, rows, score, i, what):
        wins = score > best[at, rows]
        rows = rows[wins]
        best[at, rows], start[at, rows], piece[at, rows] = score[wins], i, what[wins]


class Decoder:
    """Decodes ids in bulk by gathering the bytes of their pieces."""

    def __init__(self, tables: Tables):
        count = np.array([len(p) for p in tables.out] + [0], np.int64)  # the last stands for ids outside the vocabulary
        self.first, self.count = np.cumsum(count) - count, count
        self.bytes = np.frombuffer(b"".join(tables.out), np.uint8)

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """``ids`` of all texts and their offsets, to the texts."""
        ids = np.where((ids >= 0) & (ids < len(self.count) - 1), ids, len(self.count) - 1)
        data = self.bytes[ragged(self.first[ids], self.count[ids])]
        cuts = np.concatenate([[0], np.cumsum(self.count[ids])])[ends]
        first = np.zeros(len(ends) - 1, np.uint8)
        full = cuts[1:] > cuts[:-1]
        first[full] = data[cuts[:-1][full]]
        keep = np.ones(len(data), bool)
        keep[cuts[:-1][full & (first == 32)]] = False  # the marker in front
        data = data[keep].tobytes()
        cuts = cuts - np.concatenate([[0], np.cumsum(full & (first == 32))])
        try:
            data.decode("utf-8")
            whole = not ((first & 0xC0) == 0x80).any()
        except UnicodeDecodeError:
            whole = False
        if whole and len(data) < 1 << 31:
            return pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data))
        return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(cuts.tolist(), cuts[1:].tolist())], pa.string())


class Model:
    """A piece model for the driver; its tables reach the tasks by one broadcast."""

    def __init__(self, spark, path: str = MODEL):
        with open(path, "rb") as file:
            self.tables = Tables(file.read())
        self.shared = spark.sparkContext.broadcast(vars(self.tables))


def _parts(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` units in all."""
    if batch.num_rows:
        group = (np.cumsum(sizes) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables.of(shared.value)
        encoder = Encoder(tables)
        byte_ids = np.zeros(len(tables.out) + 1, bool)
        byte_ids[sorted(tables.byte_ids)] = True
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
            for part in _parts(batch, sizes, BYTES_AT_ONCE):
                ids, ends = encoder.ids(list(byte_rows(part.column(part.num_columns - 1))))
                is_byte = np.concatenate([[0], np.cumsum(byte_ids[ids])])[ends]
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], lists, pa.array(np.diff(ends).astype(np.int32)), pa.array(np.diff(is_byte).astype(np.int32))],
                    names=[*part.schema.names[:-1], "ids", "n_ids", "n_byte_ids"])
    return run


def encode(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per input row: id, (the text,) ids array<int>, n_ids, n_byte_ids.  No shuffle."""
    cols = [F.col(id_col).cast("long").alias("doc_id"), *([F.col(text_col).alias("text")] if keep_text else []), F.col(text_col).alias("t")]
    return map_arrow(df.select(*cols), _encode(model.shared), f"doc_id long, {'text string, ' if keep_text else ''}ids array<int>, n_ids int, n_byte_ids int")


def _decode(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Tables.of(shared.value))
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            for part in _parts(batch, sizes, BYTES_AT_ONCE):
                lists = part.column(at)
                ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)  # a null list has no ids
                ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, decoder.texts(ids, ends)], names=[*part.schema.names, "decoded"])
    return run


def decode(df: DataFrame, model: Model, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` behind its columns, which must not have that name yet.  No shuffle."""
    fields = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return map_arrow(df, _decode(model.shared, df.columns.index(ids_col)), f"{fields}, decoded string")


def _round_trip(shared):
    encode_part = _encode(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Tables.of(shared.value))
        for part in encode_part(batches):  # doc_id, text, ids, n_ids, n_byte_ids
            lists = part.column(2)
            decoded = decoder.texts(lists.values.to_numpy(), lists.offsets.to_numpy().astype(np.int64))
            same = pc.equal(decoded, pc.fill_null(part.column(1), ""))
            yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[2:], pc.utf8_length(decoded), same],
                                             names=["doc_id", "ids", "n_ids", "n_byte_ids", "n_decoded", "round_trip"])
    return run


def round_trip(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode again in one pass: doc_id, ids, n_ids, n_byte_ids, n_decoded (characters), round_trip."""
    cols = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(text_col).alias("t")]
    return map_arrow(df.select(*cols), _round_trip(model.shared),
                     "doc_id long, ids array<int>, n_ids int, n_byte_ids int, n_decoded int, round_trip boolean")
