"""Spelling variants by permuterm rotations.

Words are counted over all texts (each task folds its own first), and every
rotation of every terminator-marked word is sorted.  A rotation that ends in an
edited character shares all before it with the rotations of the words that hold
another character there (a replacement), and all of it with a rotation of the
word that holds none (an indel).  So the rotations whose prefix is a rotation
less its last character make one range of the sorted order, of which only the
prefix itself and its extensions by one character count.  One scan keeps the
open ranges on a stack, at most one per character, and emits for each member
how many near words it has there and the most frequent of them.  A range holds
at most one word per character of the alphabet and one without.

Every word is found at most once per neighbour: a replacement has one place, and
of a run of equal characters only the first stands for the indel.

Rotations are dealt out by range of their first ``HEAD`` characters, which all
members of a range share, as words are at least that long.

Words: see ``counted``.  A word's form is its near word of the largest count, if
that is ``ratio`` times its own or more; its root is where the forms end.

Defined cases: a null or empty text has no words; a null id counts as an empty
string in a word's hash; repeated rows count as often as they stand; ties go to
the word smallest in code-point order; empty tables give no rows; texts may be of
any length; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import record_batches
from .common import byte_rows, map_arrow, staged

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, RATIO, DIVISOR = 6, 5, 5, 199
#: Ends a word; sorts before every letter.
MARK = "$"
HEAD = 6
#: Distinct words a task holds before it passes its counts on.
HELD = 1 << 18

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _count(divisor: int, least_length: int, held: int):
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1))):
                seed = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs(data.lower().decode("utf-8", "replace"))).items():  # bytes: A-Z alone
                    h = crc32(word.encode(), seed)
                    if h % divisor == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least_length:
                            continue
                    counts[word] += n
                if len(counts) > held:
                    yield from record_batches(iter(counts.items()), _COUNTS)
                    counts.clear()
        yield from record_batches(iter(counts.items()), _COUNTS)
    return run


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR, least_length: int = LEAST_LENGTH,
            least_count: int = LEAST_COUNT, held: int = HELD) -> DataFrame:
    """word, n: runs of letters with A-Z lower-cased; where ``divisor`` divides the crc32 h of ``<id>:<run>``, the run's
    code point h % length is left out.  Of ``least_length`` code points and ``least_count`` occurrences at least."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, _count(divisor, least_length, held), "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")).filter(F.col("n") >= least_count)


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])


def _emit(whole: tuple | None, members: list[tuple]) -> Iterator[tuple]:
    """A row per word of one range: how many near words it has there, and the most frequent."""
    if len(members) + (whole is not None) < 2:
        return
    if len(members) > 1:
        first, second = sorted((-n, word) for word, n, _ in members)[:2]
    firsts = [(-n, word) for word, n, leads in members if leads]
    for word, n, leads in members:
        best = [(first if first[1] != word else second)] if len(members) > 1 else []
        if leads and whole:
            best.append((-whole[1], whole[0]))
        if best:
            least = min(best)
            yield word, len(members) - 1 + (leads and whole is not None), -least[0], least[1]
    if whole and firsts:
        least = min(firsts)
        yield whole[0], len(firsts), -least[0], least[1]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rotations in order: ranges open at a prefix and close behind its last extension."""
    def rows():
        stack: list[tuple[str, tuple | None, list]] = []  # prefix, the word whose rotation it is, words that extend it
        for batch in batches:
            for rotation, word, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                while stack and not rotation.startswith(stack[-1][0]):
                    yield from _emit(*stack.pop()[1:])
                if rotation[-1] != MARK:
                    prefix = rotation[:-1]
                    if not stack or len(stack[-1][0]) != len(prefix):
                        stack.append((prefix, None, []))
                    stack[-1][2].append((word, n, prefix[-1] != rotation[-1]))
                stack.append((rotation, (word, n), []))
        while stack:
            yield from _emit(*stack.pop()[1:])
    yield from record_batches(rows(), _NEAR)


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, near, near_n of the words (word, n) that have near words: the count and the most frequent."""
    marked = words.select("word", "n", F.concat("word", F.lit(MARK)).alias("marked"))
    turn = marked.select("word", "n", "marked", F.explode(F.sequence(F.lit(1), F.length("marked"))).alias("at"))
    rotated = turn.select(F.concat(F.expr("substring(marked, at)"), F.expr("substring(marked, 1, at - 1)")).alias("rotation"), "word", "n")
    ordered = rotated.repartitionByRange(F.substring("rotation", 1, HEAD)).sortWithinPartitions("rotation")
    found = map_arrow(ordered, _scan, "word string, n_near long, near_n long, near string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    return best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n of every word (word, n)."""
    near = near_words(words).withColumnRenamed("word", "of_word")
    taken = F.col("near_n") >= ratio * F.col("n")
    return words.join(near, F.col("word") == F.col("of_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(taken, F.col("near")).alias("form"),
        F.when(taken, F.col("near_n")).alias("form_n"))


def roots(formed: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, root: where the forms end, by pointer doubling.

    Counts grow ``ratio``-fold along forms, so a chain has at most log(largest count) links, and the rounds are few.
    """
    links = formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    largest = formed.agg(F.max("n")).first()[0]
    chain = math.ceil(math.log(max(largest or 1, 2), ratio)) + 1
    links = staged(links, "spelling-links")
    for _ in range(max(1, math.ceil(math.log2(chain)))):
        ahead = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        links = staged(links.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-links")
    return links


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO, **counting) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts (see ``counted``)."""
    words = staged(counted(docs, id_col, text_col, **counting), "spelling-words")
    formed = staged(forms(words, ratio), "spelling-forms")
    found = roots(formed, ratio).withColumnRenamed("word", "of_word")
    return formed.join(found, F.col("word") == F.col("of_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
