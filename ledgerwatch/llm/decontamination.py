"""Benchmark decontamination by template canonicalisation.

Texts become token templates: numbers, units behind a number, and names turn
into typed placeholders, everything else is lower-cased.  Windows of ``window``
tokens are hashed and joined with the benchmark's windows.  A document leaks an
item in one of two ways, each at ``containment`` of the item's windows or more:

* ``exact``: the item's literal windows occur in the document;
* ``template``: its template windows occur on neighbouring diagonals (distances
  of document and item place, at most ``DRIFT`` tokens from one of them) and the
  slots are consistent: a value that the item repeats is replaced by the same
  value throughout.  From a diagonal outwards, one whose slots contradict those
  taken before is left out.

A run of names, or of number words behind a number, is one placeholder, so that
'Paris' and 'New York', '48' and 'forty eight' have the same windows.  Places
are those of the plain tokens.

Each text is hashed in variants: all words literal, numbers and units as
placeholders, names too, and capitalised words that open a sentence too, so
that a passage set in other capitals is found by the first ones and a question
whose sentences open with another name by the last.
A two-bit Bloom filter of fixed size (``FILTER_BITS``, 2 MB whatever the
benchmark's size) keeps document windows that cannot match out of the shuffle;
what passes is joined exactly.

Items with the same windows and the same pattern of equal slots in a variant
are one class there, joined once through its smallest item, so a question in
many parameterisations meets a document once.  A document that lacks all of a
class's rarest windows, one more than it may lack, cannot leak it; only those
windows look for candidates, so a prompt that many items share multiplies
nothing, and a candidate's other windows are counted by document and hash.

Defined cases: null texts have no windows; an item with fewer than ``window``
tokens leaks where all its tokens stand in a row, one whose windows are nearly
all placeholders by its literal windows, one without a token never; letters of
scripts without spaces are tokens of their own; a text that holds an item many times leaks it once; rows without an id
are not reported; repeated ids or items count as one; empty tables give no
rows; other columns are not read by ``leaks`` and pass through ``clean``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain
from string import punctuation

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import byte_rows, map_arrow, ragged, staged

WINDOW = 5
CONTAINMENT = 0.8
#: A window needs so many words that are no placeholders.
LEAST_WORDS = 2
#: Tokens by which words put in or left out may shift the windows of a re-parameterised item.
DRIFT = 16
FILTER_BITS = 1 << 24
#: Tokens that are hashed at a time, and words that are remembered.
CHUNK, MEMO = 1 << 18, 1 << 19

NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen
    fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred
    thousand million billion dozen""".split())
UNITS = frozenset("""mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t gram grams kilogram
    kilograms lb lbs pound pounds oz ounce ounces ton tons ml l litre litres liter liters gallon gallons cup cups s sec
    second seconds min minute minutes h hr hour hours day days week weeks month months year years cent cents dollar
    dollars euro euros usd eur gbp percent degrees celsius fahrenheit kmh mph hz khz mhz ghz w kw v a j kj cal kcal
    pa kpa bar b kb mb gb tb bit bits byte bytes meter meters metre metres kilometer kilometers kilometre kilometres
    centimeter centimeters centimetre centimetres""".split())

#: Letters of scripts without spaces (Thai, Lao, Burmese, Khmer, kana, Han); each is a token.
_UNSPACED = ("\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ece\u0edc-\u0edf\u1000-\u103f\u1050-\u108f\u1780-\u17d3\u3005-\u3007\u3041-\u3096"
             "\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff")
_TOKEN = re.compile(rf"\d+(?:[.,]\d+)*|[{_UNSPACED}]|[^\W\d_{_UNSPACED}]+")
_DENSE = re.compile(f"[{_UNSPACED}]")


def _is_word(text: str) -> bool:
    """Whether the letters of the text are one token."""
    return text.isalpha() and (text.isascii() or not _DENSE.search(text))


WORD, NUMBER, UNIT, CAPITAL, NAME, DIGITS = range(6)
#: Bits of a kind: behind the token a sentence ends; a run of names or numbers ends.
_END, _BREAK = 8, 16
SHORT, LITERAL, SLOT, NAMED, OPENER = range(-1, 4)
_PUNCTUATION, _STOPS = punctuation.encode(), frozenset(b".!?:;")
_PLACES = np.array([xxhash.xxh64_intdigest(f"<{k}>".encode()) for k in ("", "number", "unit", "", "name")], np.uint64)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _kinds(names: Iterable[str]) -> dict[str, int]:
    return {u: UNIT for u in UNITS} | {n: NUMBER for n in NUMBER_WORDS} | {n.lower(): NAME for n in names}


class Words:
    """Tokens of white-space words, remembered by word: literal hash, and kind with bits for what ends behind it."""

    def __init__(self, names: Iterable[str] = ()):
        self.kinds = _kinds(names)
        self.clear()

    def clear(self):
        self.place: dict[bytes, int] = {}
        self.first, self.count, self.literal, self.kind = (np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.int8))

    def learn(self, new: set[bytes]):
        words, texts, rest = [], [], []
        for word in new:
            text = word.decode("utf-8", "replace")
            if _is_word(text):
                words.append(word)
                texts.append(text)
            else:
                rest.append((word, text))
        plain = len(texts)
        odd = []
        for word, text in rest:
            core = text.strip(punctuation)
            if _is_word(core):  # letters with punctuation around them
                words.append(word)
                texts.append(core)
            else:
                odd.append((word, text))
        low = [t.lower() for t in texts]
        literal = list(map(xxhash.xxh64_intdigest, low))
        get = self.kinds.get
        kind = [get(x, WORD) or (CAPITAL if t != x and t[0].isupper() and (len(t) == 1 or not t.isupper()) else WORD) for t, x in zip(texts, low)]
        for k in range(plain, len(texts)):
            word = words[k]
            behind = word[len(word.rstrip(_PUNCTUATION)):]
            kind[k] += (0 if _STOPS.isdisjoint(behind) else _END) + (_BREAK if behind else 0)
        count = [1] * len(words)
        for word, text in odd:
            n, at = len(literal), -1
            for m in _TOKEN.finditer(text):
                if at >= 0 and text[at:m.start()].strip("-'\u2019\u00a0"):
                    kind[-1] += _BREAK
                token, at = m[0], m.end()
                x = token.lower()
                known = DIGITS if token[0].isdigit() else get(x, WORD)
                if known == WORD and token[0].isupper() and (len(token) == 1 or not token.isupper()):
                    known = CAPITAL
                literal.append(xxhash.xxh64_intdigest(x))
                kind.append(known)
            if at >= 0:
                kind[-1] += (_END if any(c in ".!?:;" for c in text[at:]) else 0) + (_BREAK if text[at:] else 0)
            words.append(word)
            count.append(len(literal) - n)
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        count = np.array(count, np.int64)
        self.first = np.concatenate([self.first, len(self.literal) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.literal = np.concatenate([self.literal, np.array(literal, np.uint64)])
        self.kind = np.concatenate([self.kind, np.array(kind, np.int8)])

    def tokens(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Literal hashes and kinds of the tokens of many texts, and the offsets of the texts."""
        if len(self.place) > MEMO:
            self.clear()
        new = set(chain.from_iterable(texts)).difference(self.place)
        if new:
            self.learn(new)
        ids = np.fromiter(map(self.place.__getitem__, chain.from_iterable(texts)), np.int64, sum(map(len, texts)))
        count = self.count[ids]
        at = ragged(self.first[ids], count)
        ends = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)]
        return self.literal[at], self.kind[at], ends


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _rolled(h: np.ndarray, window: int) -> np.ndarray:
    n = max(0, len(h) - window + 1)
    out = np.zeros(n, np.uint64)
    for k in range(window):
        out = out * _PRIME + h[k:k + n]
    return _mix(out)


def windows(words: Words, texts: list[list[bytes]], window: int, full: bool = False, widths: Iterable[int] = ()) -> Iterator[tuple]:
    """Windows of many texts: variant, first tokens, hashes, literal hashes of the slots (0 elsewhere), and the offsets of the texts.

    A variant has only the windows that hold one of its own placeholders; the others are those of the variant before.
    ``full`` adds these for texts that have windows of their own in the variant, and texts of under ``window`` tokens
    as one window each (variant SHORT); else SHORT are all windows of ``widths`` tokens.
    """
    literal, kind, ends = words.tokens(texts)
    if not len(literal):
        return
    end, broken, kind = (kind & _END) > 0, (kind & _BREAK) > 0, kind & (_END - 1)
    first = np.zeros(len(literal), bool)
    first[ends[:-1][ends[:-1] < len(literal)]] = True
    spoken = kind == NUMBER
    number = spoken | (kind == DIGITS)
    behind = np.zeros(len(literal), bool)
    behind[1:] = number[:-1] & ~first[1:]
    slot = np.where(number, NUMBER, np.where((kind == UNIT) & behind, UNIT, WORD)).astype(np.int8)
    opens = first.copy()
    opens[1:] |= end[:-1]
    names = (kind == NAME) | (kind == CAPITAL) & ~opens
    openers = (kind == CAPITAL) & opens
    joins = ~first
    joins[1:] &= ~(broken | end)[:-1]
    for width in range(1, window) if full else widths:
        good = ends[:-1][np.diff(ends) == width] if full else np.flatnonzero(_whole(ends, len(literal), width))
        yield SHORT, good, _rolled(literal, width)[good] + np.uint64(width), np.zeros((len(good), width), np.uint64), ends
    good = np.flatnonzero(_whole(ends, len(literal), window))
    yield LITERAL, good, _rolled(literal, window)[good], np.zeros((len(good), window), np.uint64), ends
    before = None
    for variant, own, named in ((SLOT, slot > 0, None), (NAMED, names, names), (OPENER, openers, names | openers)):
        slots = slot if named is None else np.where(named, np.int8(NAME), slot)
        if not own.any():
            if full and before is None:
                before = good, _rolled(literal, window)[good], np.zeros((len(good), window), np.uint64)
            continue
        run = np.zeros(len(literal), bool)  # the token goes on with the placeholder of the one before
        run[1:] = joins[1:] & (slots[1:] == slots[:-1]) & ((slots[1:] == NAME) | spoken[1:] & (slots[1:] == NUMBER))
        starts = np.flatnonzero(~run)
        values = literal.copy()
        values[run] = _mix(literal[run] + (np.arange(len(literal)) - starts[np.cumsum(~run) - 1])[run].astype(np.uint64))
        values, own, slots = np.add.reduceat(values, starts), np.logical_or.reduceat(own, starts), slots[starts]
        usable = _whole(np.searchsorted(starts, ends), len(starts), window)
        if len(usable):
            usable &= _sums(slots > 0, window) <= window - LEAST_WORDS
        new = np.flatnonzero(usable & (_sums(own, window) > 0)) if len(usable) else np.zeros(0, np.int64)
        hashes = _rolled(np.where(slots > 0, _PLACES[slots], values), window)[new] if len(new) else np.zeros(0, np.uint64)
        at = new[:, None] + np.arange(window)
        rows = starts[new], hashes, np.where(slots[at] > 0, values[at], np.uint64(0))
        if full:
            if before is None:  # of the literal windows, those that hold no placeholder
                plain = np.flatnonzero(usable & (_sums(own, window) == 0)) if len(usable) else np.zeros(0, np.int64)
                held = np.searchsorted(good, starts[plain])
                older = good[held], _rolled(literal, window)[good[held]], np.zeros((len(held), window), np.uint64)
            else:
                kept = ~run[before[0]] & ~np.isin(before[0], rows[0])
                older = tuple(x[kept] for x in before)
            before = tuple(np.concatenate([x, y]) for x, y in zip(rows, older))
            text = lambda x: np.searchsorted(ends, x, side="right") - 1
            of = np.isin(text(before[0]), text(rows[0]))
            yield variant, *(x[of] for x in before), ends
        else:
            yield variant, *rows, ends


def _whole(ends: np.ndarray, n_tokens: int, window: int) -> np.ndarray:
    """Whether the window from each token stays in its text."""
    n = max(0, n_tokens - window + 1)
    whole = np.ones(n, bool)
    for k in range(1, window):
        over = ends[1:-1] - k
        whole[over[(over >= 0) & (over < n)]] = False
    return whole


def _sums(flags: np.ndarray, window: int) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
    return total[window:] - total[:-window]


_SCHEMA = pa.schema([("id", pa.int64()), ("variant", pa.int8()), ("place", pa.int64()), ("hash", pa.int64()),
                     ("slots", pa.list_(pa.int64()))])
_DDL = "id long, variant byte, place long, hash long, slots array<long>"
#: The benchmark's windows: slots are labels of equal values, and a digest tells the class of the item in the variant.
_ITEM_SCHEMA = _SCHEMA.append(pa.field("class", pa.binary()))
_ITEM_DDL = _DDL + ", class binary"
#: Parts into which the windows of one hash are dealt by document.
SALTS = 8


def _labels(text: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """For every slot value, 1 + where its text has it first; the rows come by text and place."""
    width = slots.shape[1]
    flat, of = slots.ravel(), np.repeat(text, width).astype(np.uint64)
    _, at, which = np.unique(np.stack([of, flat], 1), axis=0, return_index=True, return_inverse=True)
    start = np.searchsorted(text, text) * width
    return np.where(flat > 0, at[which.ravel()] - np.repeat(start, width) + 1, 0).astype(np.uint64).reshape(slots.shape)


def _digests(text: np.ndarray, variant: int, *rows: np.ndarray) -> list[bytes]:
    """A digest of the rows of its text for every row."""
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(text)) + 1, [len(text)]])
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        data = b"".join([bytes([variant + 1]), *(x[a:b].tobytes() for x in rows)])
        out += [xxhash.xxh3_128_digest(data)] * int(b - a)
    return out


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return h & np.uint64(FILTER_BITS - 1), (h >> np.uint64(32)) & np.uint64(FILTER_BITS - 1)


def _windows(window: int, names: tuple[str, ...], filter_of=None, widths: tuple[int, ...] = ()):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(names)
        bits = filter_of.value if filter_of is not None else None

        def rows(ids: list, texts: list) -> Iterator[pa.RecordBatch]:
            ids = np.array(ids, np.int64)
            for variant, good, hashes, slots, ends in windows(words, texts, window, bits is None, widths):
                if bits is not None:
                    a, b = _places(hashes)
                    one = np.uint64(1)
                    hit = np.flatnonzero(bits[a >> np.uint64(6)] >> (a & np.uint64(63)) & one)
                    b = b[hit]
                    hit = hit[(bits[b >> np.uint64(6)] >> (b & np.uint64(63)) & one).astype(bool)]
                    good, hashes, slots = good[hit], hashes[hit], slots[hit]
                if not len(good):
                    continue
                text = np.searchsorted(ends, good, side="right") - 1
                if variant == SHORT:  # once a text will do
                    _, once = np.unique(np.stack([text.astype(np.uint64), hashes], 1), axis=0, return_index=True)
                    good, hashes, slots, text = good[once], hashes[once], slots[once], text[once]
                extra = []
                if bits is None:
                    order = np.lexsort((good, text))
                    good, hashes, slots, text = good[order], hashes[order], slots[order], text[order]
                    slots = _labels(text, slots)
                    extra = [pa.array(_digests(text, variant, good - ends[text], hashes, slots), pa.binary())]
                filled = np.ascontiguousarray(slots).view(np.int64).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(filled) + 1, slots.shape[1]), pa.int32()), pa.array(filled))
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[text]), pa.array(np.full(len(good), variant, np.int8)), pa.array(good - ends[text]),
                    pa.array(hashes.view(np.int64)), lists, *extra], schema=_ITEM_SCHEMA if extra else _SCHEMA)

        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1))):
                if doc_id is None:
                    continue
                ids.append(doc_id)
                texts.append(text.split())
                size += len(texts[-1])
                if size >= CHUNK:
                    yield from rows(ids, texts)
                    ids, texts, size = [], [], 0
            yield from rows(ids, texts)
    return run


def _filter(items: DataFrame) -> np.ndarray:
    """The Bloom filter of the benchmark's window hashes: at most ``FILTER_BITS / 64`` rows reach the driver."""
    low, high = F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1)), F.shiftrightunsigned("hash", 32).bitwiseAND(F.lit(FILTER_BITS - 1))
    bit = items.select(F.explode(F.array(low, high)).alias("bit"))
    rows = bit.groupBy(F.shiftright("bit", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    found = np.zeros(FILTER_BITS // 64, np.int64)
    for r in rows.toLocalIterator():
        found[r["w"]] = r["bits"]
    return found.view(np.uint64)


#: Windows of an item on the diagonals around one, taken from it outwards as long as their slots do not contradict.
_ALIGNED = """
size(aggregate(
    array_sort(transform(near, x -> struct(abs(x.diagonal - diagonal) as far, x.diagonal as at, x.hits as hits))),
    struct(cast(array() as array<bigint>) as places, cast(array() as array<struct<item_slots: bigint, slots: bigint>>) as pairs),
    (acc, x) -> transform(array(filter(x.hits, h -> not array_contains(acc.places, h.place))),
        new -> transform(array(array_distinct(concat(acc.pairs, flatten(transform(new, h -> h.pairs))))),
            pairs -> if(size(pairs) = size(array_distinct(transform(pairs, p -> p.item_slots))),
                        struct(concat(acc.places, transform(new, h -> h.place)) as places, pairs as pairs), acc))[0])[0],
    acc -> acc.places))
"""


def _classes(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Windows of the smallest item of every class, and the items of the classes of every variant.

    Classes with the same items in several variants have one ``class_id``.
    """
    of_item = own.select("id", "variant", "class").distinct()
    least = of_item.groupBy("variant", "class").agg(F.min("id").alias("item_id"), F.count(F.lit(1)).alias("n"),
                                                    F.expr("bit_xor(xxhash64(id))").alias("x"), F.expr("bit_xor(xxhash64(id, 1))").alias("y"))
    least = least.withColumn("class_id", F.concat_ws("-", F.col("item_id"), F.col("n"), F.hex("x"), F.hex("y")))
    members = staged(of_item.join(least, ["variant", "class"]).select(
        F.col("variant").alias("iv"), "item_id", "class_id", F.col("id").alias("member")), "benchmark-classes")
    items = own.join(least.select("variant", "class", F.col("item_id").alias("least")), ["variant", "class"]).filter(
        F.col("id") == F.col("least")).select(F.col("id").alias("item_id"), F.col("variant").alias("iv"), F.col("place").alias("item_place"),
                                              F.col("hash").alias("item_hash"), F.col("slots").alias("item_slots"))
    return items, members


def _rarest(items: DataFrame, totals: DataFrame, containment: float) -> DataFrame:
    """The windows of every class that fewest classes hold, one more than a document may lack."""
    often = items.groupBy("item_hash").agg(F.count(F.lit(1)).alias("often"))
    order = Window.partitionBy("item_id", "iv").orderBy("often", "item_place")  # as long as an item
    ranked = items.drop("item_slots").join(often, "item_hash").withColumn("rank", F.row_number().over(order))
    need = F.greatest(F.ceil(F.col("total") * containment - 1e-9), F.lit(1))
    return ranked.join(totals, (F.col("item_id") == F.col("ti")) & (F.col("iv") == F.col("tv"))).filter(
        F.col("rank") <= F.col("total") - need + 1).select("item_id", "iv", "item_hash")


def _leaked(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int,
            containment: float, names: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """One row per document and leaked class, and the classes' items."""
    spark = docs.sparkSession
    unique = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t")).groupBy("i").agg(F.max("t").alias("t"))
    own = staged(map_arrow(unique, _windows(window, names), _ITEM_DDL), "benchmark-windows")
    items, members = _classes(own)
    items = staged(items, "benchmark-items")
    totals = items.groupBy(F.col("item_id").alias("ti"), F.col("iv").alias("tv")).agg(F.count(F.lit(1)).alias("total"))
    bloom = spark.sparkContext.broadcast(_filter(items.withColumnRenamed("item_hash", "hash")))
    widths = tuple(r["w"] for r in items.filter(F.col("iv") == SHORT).select(F.size("item_slots").alias("w")).distinct().collect())  # under ``window``
    found = staged(map_arrow(docs.select(F.col(id_col).cast("long"), F.col(text_col)), _windows(window, names, bloom, widths), _DDL), "benchmark-found")
    keys = ["doc_id", "item_id", "variant"]
    rare = _rarest(items, totals, containment).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = found.select(F.col("id").alias("doc_id"), "hash", F.pmod("id", F.lit(SALTS)).cast("int").alias("salt")).distinct()
    candidates = dealt.join(rare, (F.col("hash") == F.col("item_hash")) & (dealt["salt"] == rare["salt"])).select("doc_id", "item_id", "iv").distinct()
    wanted = candidates.join(items, ["item_id", "iv"])
    pairs = F.filter(F.arrays_zip("item_slots", "slots"), lambda p: p["item_slots"] != 0)
    met = found.join(wanted, (F.col("id") == F.col("doc_id")) & (F.col("hash") == F.col("item_hash"))).select(
        "doc_id", "item_id", F.col("iv").alias("variant"), "item_place", (F.col("place") - F.col("item_place")).alias("diagonal"),
        pairs.alias("pairs"))
    met = staged(met, "benchmark-hits")  # small, and read twice below
    of_total = (F.col("item_id") == F.col("ti")) & (F.col("variant") == F.col("tv"))
    places = met.select(*keys, "item_place").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    # No alignment has more windows than all diagonals together.
    held = staged(places.join(totals, of_total).filter(F.col("n") / F.col("total") >= containment), "benchmark-held").select(*keys, "n", "total")
    exact = held.filter(F.col("variant") <= LITERAL).select(*keys, (F.col("n") / F.col("total")).alias("e"), F.lit(0.0).alias("t"), "n")
    whole = met.filter(F.col("variant") > LITERAL).join(held.select(*keys), keys, "left_semi")
    # A document's windows on one diagonal are as many as the item's, so the sets below stay as small as an item.
    aligned = whole.groupBy(*keys, "diagonal").agg(F.collect_set(F.struct(F.col("item_place").alias("place"), "pairs")).alias("hits"))
    near = Window.partitionBy(*keys).orderBy("diagonal").rangeBetween(-DRIFT, DRIFT)
    around = aligned.withColumn("near", F.collect_list(F.struct("diagonal", "hits")).over(near))
    best = around.select(*keys, F.expr(_ALIGNED).alias("n")).groupBy(*keys).agg(F.max("n").alias("n"))
    template = best.join(held.drop("n"), keys).select(*keys, F.lit(0.0).alias("e"), (F.col("n") / F.col("total")).alias("t"), "n")
    sets = members.filter(F.col("item_id") == F.col("member")).select("item_id", F.col("iv").alias("variant"), "class_id")
    per = exact.unionByName(template).join(sets, ["item_id", "variant"]).groupBy("doc_id", "class_id", "item_id").agg(
        F.max("e").alias("e"), F.max("t").alias("t"), F.max("n").alias("n"))
    rows = per.filter(F.greatest("e", "t") >= containment).select(
        "doc_id", "item_id", F.when(F.col("e") >= containment, "exact").otherwise("template").alias("kind"),
        F.round(F.greatest("e", "t"), 6).alias("containment"), F.col("n").cast("int").alias("n_windows"), "class_id")
    return staged(rows, "leaks"), members.select("class_id", "member").distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", window: int = WINDOW, containment: float = CONTAINMENT,
          names: Iterable[str] = ()) -> DataFrame:
    """Documents and the items they leak: doc_id, item_id, kind, containment, n_windows, class_id.

    A document that leaks a class leaks every item of it.  The smallest document
    of a class has a row for each of its items, the other documents one row,
    with the smallest item; so there are rows for documents plus items, and the
    items of a class are those with its ``class_id`` (see ``every_pair``).

    ``names`` adds given names that are placeholders in whatever case, with those within a sentence.
    """
    rows, members = _leaked(docs, benchmark, id_col, text_col, item_col, item_text_col, window, containment, tuple(names))
    first = rows.groupBy("class_id").agg(F.min("doc_id").alias("doc_id"))
    listed = rows.join(first, ["class_id", "doc_id"], "left_semi").join(members, "class_id").filter(F.col("member") != F.col("item_id"))
    return rows.unionByName(listed.drop("item_id").withColumnRenamed("member", "item_id"))


def every_pair(found: DataFrame) -> DataFrame:
    """All pairs of a document and an item that rows of ``leaks`` stand for; as many as documents times items of a class."""
    of_class = found.select("class_id", F.col("item_id").alias("member")).distinct()
    once = found.dropDuplicates(["doc_id", "class_id"]).drop("item_id")
    pairs = once.join(of_class, "class_id").groupBy("doc_id", F.col("member").alias("item_id"))
    return pairs.agg(F.min("kind").alias("kind"), F.max("containment").alias("containment"), F.max("n_windows").alias("n_windows"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", window: int = WINDOW, containment: float = CONTAINMENT, names: Iterable[str] = ()) -> DataFrame:
    """The rows of ``docs`` that leak no item, whole; rows without an id stay."""
    rows, _ = _leaked(docs, benchmark, id_col, text_col, item_col, item_text_col, window, containment, tuple(names))
    found = staged(rows.select(F.col("doc_id").alias("__leak_id")).distinct(), "leak-ids")  # its size is known when the next join is planned
    return docs.join(found, docs[id_col].cast("long") == F.col("__leak_id"), "left_anti").select(*docs.columns)
