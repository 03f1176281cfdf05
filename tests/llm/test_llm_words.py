"""Operators 11 to 13 against brute force, the public library and SQL, and their defined edge cases."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerwatch.llm import blocks, byte_bpe, collocations, queries, spelling
from ledgerwatch.llm.common import read_table

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"


def clashing(df):
    """With columns named like those that the operators use inside."""
    for name in ("word", "block", "kind", "n", "id", "key", "bucket", "phrase", "place", "data"):
        df = df.withColumn(name, F.lit("x"))
    return df


# --- op 11 ------------------------------------------------------------------------------------------------------------

def brute_variants(rows, least_length=6, least_count=5, ratio=5, divisor=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % divisor == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least_length and c >= least_count}
    shared = {}
    for w in n:  # by definition, with deletions as meeting places
        for k in range(len(w)):
            shared.setdefault(w[:k] + "\0" + w[k + 1:], set()).add(w)
    near = {w: set() for w in n}
    for group in shared.values():
        for w in group:
            near[w] |= group - {w}
    for w in n:
        for k in range(len(w)):
            shorter = w[:k] + w[k + 1:]
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def variant_rows(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_spelling_query_equals_brute_force(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = variant_rows(queries.op11_spelling_variants(spark, SF))
    assert got == brute_variants(rows)
    assert sum(v[0] is not None for v in got.values()) > 100


@pytest.mark.parametrize("held", [1, 1 << 18])
def test_spelling_of_near_words_over_a_small_alphabet(spark, held):
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abé"), rng.integers(6, 10))) for _ in range(1500)]
    text = [(k, " ".join(words[int(x)] for x in rng.zipf(1.3, 400) if x <= len(words))) for k in range(40)]
    df = spark.createDataFrame(text, DOCS).repartition(5)
    got = variant_rows(spelling.variants(df, least_count=1, ratio=2, divisor=7, held=held))
    assert got == brute_variants(text, least_count=1, ratio=2, divisor=7)
    assert max(v[3] for v in got.values()) > 3


def test_spelling_follows_long_chains(spark):
    chain = ["aaaaaaaa"[:8 - k] + "b" * k for k in range(8)]
    text = [(None, " ".join(w for k, w in enumerate(chain) for _ in range(2 ** k)))]
    got = variant_rows(spelling.variants(spark.createDataFrame(text, DOCS), least_count=1, ratio=2, divisor=1 << 40))
    assert {w: v[1] for w, v in got.items()} == dict.fromkeys(chain, chain[-1])


def test_spelling_edges(spark):
    rows = [(1, None), (None, "Banana× " * 5), (2, ""), (3, "banana " * 30 + "banane " * 6), (3, "banana " * 30 + "banane " * 6),
            (4, "kurz " * 9), (5, "ÀÉÎÕÜß " * 6), (6, "x" * 300_000 + " ")]
    df = clashing(spark.createDataFrame(rows, DOCS)).repartition(3)
    assert variant_rows(spelling.variants(df)) == brute_variants(rows)
    assert spelling.variants(spark.createDataFrame([], DOCS)).collect() == []


# --- op 12 ------------------------------------------------------------------------------------------------------------

def brute_phrases(rows, least, longest=4):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(len(words)):
                for m in range(1, min(longest, len(words) - k) + 1):
                    counts[lang, tuple(words[k:k + m])] += 1
    return {k: v for k, v in counts.items() if v >= least}, totals


def brute_collocations(rows, least, top=2000, share=80):
    f, totals = brute_phrases(rows, least)
    most = {}
    for (lang, w), n in f.items():
        for size in range(2, len(w)):
            for s in range(len(w) - size + 1):
                key = lang, w[s:s + size]
                most[key] = max(most.get(key, 0), n)
    found = {}
    for (lang, w), a in f.items():
        if len(w) < 2 or 100 * most.get((lang, w), 0) >= share * a:
            continue
        score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, rank, p.decode(), -a, left, right, totals[lang], -score)
            for lang, rows in found.items() for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1)}


def collocation_rows(df):
    return [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]


def test_collocation_query_equals_brute_force(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "documents").select("lang", "text").collect()]
    got = collocation_rows(queries.op12_collocations(spark, SF))
    assert len(got) == len(set(got)) > 100 and set(got) == brute_collocations(rows, 30)


@pytest.mark.parametrize("settings", [{}, {"block_words": 50, "merge": 3, "dense": 4}, {"block_words": 1, "merge": 1000, "dense": 1}])
def test_collocations_over_any_blocks_and_tiles(spark, settings):
    rng = np.random.default_rng(12)
    vocabulary = [f"w{k}" for k in range(1500)] + ["Ä", "\x1c", "é-"]
    rows = []
    for k in range(120):
        words = [vocabulary[min(int(x), 1502)] for x in rng.zipf(1.2, 60)]
        for at in range(0, 55, 9):
            words[at:at + 4] = ["New", "york", "City", "hall"][:int(rng.integers(2, 5))]
        rows.append((["en", "de", None][k % 3], "".join(w + str(rng.choice([" ", "\t", ", ", "\n", "  "], p=[.7, .1, .1, .05, .05])) for w in words)))
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = collocation_rows(collocations.collocations(df, least=4, **settings))
    assert len(got) == len(set(got)) > 20 and set(got) == brute_collocations(rows, 4)


def test_dense_and_sparse_tiles_count_alike():
    rng = np.random.default_rng(3)
    i, j = rng.integers(0, 3000, 50_000), np.minimum(rng.zipf(1.3, 50_000), 1 << 30)
    want = Counter(zip(i.tolist(), j.tolist()))
    for dense in (1, 50, 1 << 30):
        keys, counts = collocations.count_pairs(i, j, dense)
        assert (np.diff(keys) > 0).all() and dict(zip(keys.tolist(), counts.tolist())) == {
            int(collocations.pair_keys(np.array([a]), np.array([b]))[0]): n for (a, b), n in want.items()}
        tiles = collocations.Tiles(dense, pending=1000)
        for _ in range(3):
            tiles.add(keys, counts)
        found = {k: n for ks, ns in tiles.items(6) for k, n in zip(ks.tolist(), ns.tolist())}
        assert found == {k: 3 * n for k, n in zip(keys.tolist(), counts.tolist()) if 3 * n >= 6}


def test_scores_beyond_64_bits(spark):
    big = 9 * 10 ** 18
    rows = [("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big - 1)]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, length int, f long")).first()
    assert got["score"] == 2_000_000 * (big - 1) // (2 * big)


def test_collocation_edges(spark):
    rows = [("en", None), (None, ""), (None, "a b " * 40), ("und", "A\tB " * 3), ("en", "?!" * 50), ("fr", "x y, " * 31), ("fr", "x y, " * 31),
            ("fr", "z " * 200_000)]
    df = clashing(spark.createDataFrame(rows, "lang string, text string")).repartition(3)
    got = collocation_rows(collocations.collocations(df))
    assert len(got) == len(set(got)) and set(got) == brute_collocations(rows, 30)
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_packed_integers():
    a = np.array([0, 1, 255, 256, (1 << 32) - 1], np.uint32)
    b = np.array([0, -1, 1 << 62, 5], np.int64)
    assert (blocks.unpack(blocks.pack(a)) == a).all() and (blocks.unpack64(blocks.pack64(b)) == b).all()


# --- op 13 ------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.public_vocabulary()


@pytest.fixture(scope="module")
def library(vocabulary):
    ranks, pattern = vocabulary
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def brute_round_trip(rows, library):
    out = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_bpe_query_equals_the_public_library(spark, library):
    rows = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = queries.op13_byte_bpe(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_round_trip(rows, library)


def test_splits_as_the_public_library_at_every_code_point(vocabulary, library):
    import regex

    ranks, pattern = vocabulary
    split = regex.compile(pattern).findall
    for c in [*range(0xD800), *range(0xE000, 0x30000, 7)]:
        text = f"a{chr(c)} 1{chr(c)}  {chr(c)}?"
        assert [i for chunk in byte_bpe._CHUNKS.findall(text) for w in split(chunk) for i in byte_bpe.merged(w.encode(), ranks)] == \
            library.encode_ordinary(text), hex(c)


@pytest.mark.parametrize("block_bytes", [1, 1000, 4 << 20])
def test_bpe_edges(spark, vocabulary, library, block_bytes):
    rng = np.random.default_rng(13)
    odd = "".join(chr(int(c)) for c in rng.choice([9, 10, 32, 39, 65, 115, 0x1c, 0x85, 0xA0, 0xE9, 0x661, 0x3000, 0x4E2D, 0x1F600, 0x301], 4000))
    rows = [(1, None), (2, ""), (None, "we'll  see<|endoftext|> "), (3, odd), (3, odd), (4, "漢字かな" * 20_000), (5, " " * 70_000), (6, "ab" * 60_000)]
    df = clashing(spark.createDataFrame(rows, DOCS)).repartition(3)
    got = byte_bpe.round_trip(df, *vocabulary, block_bytes=block_bytes)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_round_trip(rows, library)
    assert byte_bpe.round_trip(spark.createDataFrame([], DOCS), *vocabulary).collect() == []


def test_bpe_ids_decode_by_themselves(spark, vocabulary, library):
    ids = [(1, bytearray(np.array([5, 5, 300], "<u4").tobytes())), (2, bytearray()), (3, None)]
    table = byte_bpe.token_bytes(spark, vocabulary[0])
    df = spark.createDataFrame(ids, "doc_id long, ids binary")
    got = {r["doc_id"]: bytes(r["decoded"]) for r in byte_bpe.decode(df, table).collect()}
    assert got == {1: library.decode_bytes([5, 5, 300]), 2: b"", 3: b""}
    with pytest.raises(Exception, match="no entry"):
        byte_bpe.decode(df, table.filter("id <> 300")).collect()


def test_collocation_sql_is_registered():
    con = duckdb.connect()
    con.execute("create table documents as select 'x' as lang, 'a b' as text")
    assert con.execute(queries.ORACLE["op12_collocations"]).fetchall() == []
