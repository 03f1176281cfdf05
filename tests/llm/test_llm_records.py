"""op4: dates, codings, odd headers, text by an independent parser; op2: copies and compaction; op9: bounded blocks."""
import gzip
import os
import time
import zlib
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest

from ledgerwatch.llm import queries, simhash, token_counts, warc
from ledgerwatch.llm.common import read_table

SF = "/root/testdata/sf0.001"
DDL = "source_id long, record_id string, target_uri string, warc_date string, block binary"
BLOCKS = set("p div br li ul ol table tr td th h1 h2 h3 h4 h5 h6 article section nav header footer aside main blockquote pre form dl dt dd hr title".split())


class Text(HTMLParser):
    """Text outside head, scripts, styles, noscript and template elements; a line per block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("head", "script", "style", "noscript", "template")
        if tag in BLOCKS:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("head", "script", "style", "noscript", "template") and self.hidden > 0
        if tag in BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def build(spark, rows, default="2020-01-01T00:00:00Z"):
    return {(r["source_id"], r["record_type"]): r for r in warc.build(spark.createDataFrame(rows, DDL), default).collect()}


def test_query_texts_equal_an_independent_parser(spark):
    pages = {r["page_id"]: r["html"] or "" for r in read_table(spark, SF, "pages").collect()}
    rows = queries.op4_warc(spark, SF).collect()
    assert len(rows) == 2 * len(pages)
    for r in rows:
        assert f"WARC-Date: {queries.CAPTURED}\r\n" in r["header"]
        if r["record_type"] == "conversion":
            parser = Text()
            parser.feed(pages[r["source_id"]])
            parser.close()
            assert r["block"].split() == "".join(parser.parts).split()


def test_dates_and_header_lines(spark):
    head = b"HTTP/1.1 200 OK\r\nDate: Tue, 15 Nov 1994 08:12:31 GMT\r\nContent-Type: text/plain\r\nX-Odd: a\nWARC-Type: b\r\n\r\nx"
    got = build(spark, [(1, None, "http://a/b c\r\nEvil: 1", None, head), (2, None, None, "2021-02-03T00:00:00Z", head), (3, None, "", None, b"HTTP/1.1 200 OK\r\nDate: soon\r\n\r\n")])
    for key, date in ((1, "1994-11-15T08:12:31Z"), (2, "2021-02-03T00:00:00Z"), (3, "2020-01-01T00:00:00Z")):
        for kind in ("metadata", "conversion"):
            names = [x.partition(":")[0] for x in got[key, kind]["header"].split("\r\n") if x]
            assert f"WARC-Date: {date}\r\n" in got[key, kind]["header"] and len(names) == len(set(names)) and "Evil" not in names
    assert "WARC-Target-URI: http://a/b%20c%0D%0AEvil:%201\r\n" in got[1, "metadata"]["header"]
    assert "header-x-odd: a WARC-Type: b\r\n" in got[1, "metadata"]["block"]


def test_transfer_and_content_codings(spark):
    text = "grüße " * 5000
    page = f"<p>{text}</p>".encode()
    chunks = lambda b, n=1000: b"".join(b"%x;ext=1\r\n%s\r\n" % (len(b[k:k + n]), b[k:k + n]) for k in range(0, len(b), n)) + b"0\r\n\r\n"
    raw = zlib.compressobj(wbits=-15)
    bare = raw.compress(page) + raw.flush()
    members = gzip.compress(page[:777]) + gzip.compress(page[777:])
    cases = {1: ("gzip", "", gzip.compress(page)), 2: ("", "chunked", chunks(page)), 3: ("GZIP", "gzip, chunked", chunks(gzip.compress(page))),
             4: ("deflate", "", zlib.compress(page)), 5: ("deflate", "", bare), 6: ("x-gzip", "", members), 7: ("gzip, deflate", "", zlib.compress(gzip.compress(page))),
             8: ("", "chunked", page), 9: ("gzip", "", gzip.compress(page) + b"\0" * 9), 10: ("identity", "", page)}
    block = lambda c, t, body: (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Encoding: {c}\r\nTransfer-Encoding: {t}\r\n\r\n").encode() + body
    got = build(spark, [(k, None, "u", None, block(*c)) for k, c in cases.items()]
                + [(20, None, "u", None, block("br", "", b"xx")), (21, None, "u", None, block("gzip", "", gzip.compress(page)[:40])), (22, None, "u", None, block("gzip", "", b"no"))])
    for k in cases:
        assert got[k, "conversion"]["block"].split() == text.split(), k
    assert got[2, "conversion"]["payload_digest"] == warc.digest(page)  # the digest is of the body without its chunks
    assert got[20, "conversion"]["block"] == "" == got[22, "conversion"]["block"] and "gr" not in got[20, "metadata"]["block"].split()


@pytest.mark.parametrize("piece", ["<p ", "<meta ", "<head>", "<head ", "<!--", "<script", "<noscript>", "<div><p ", "<title>", "</p "])
def test_text_in_linear_time(piece):
    start = time.perf_counter()
    warc.plain_text((piece * 50000).encode(), "text/html")
    warc.plain_text(("<head>" + piece * 50000).encode(), "text/html")
    assert time.perf_counter() - start < 2


def test_copies_of_a_hot_text_and_odd_rows(spark):
    rows = [(k, "hot") for k in range(3000, 2000, -1)] + [(1, None), (2, ""), (3, "x"), (3, "x"), (4, "y"), (None, "hot"), (None, None), (5, "x" * 200000), (6, "x" * 200000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as sha", "2 as part", "3 as first_id", "'s' as source", "'en' as lang")
    got = sorted(r["doc_id"] for r in token_counts.copies(df).collect())
    assert got == [2, 6, *range(2002, 3001)]
    assert token_counts.copies(df.limit(0)).count() == 0
    assert token_counts.counts(df.limit(0)).count() == 0
    counted = {(r["doc_id"], r["tokenizer_version"]): r["n_tokens"] for r in token_counts.counts(df).collect()}
    assert counted[1, "whitespace_1"] == 0 and counted[5, "whitespace_1"] == 1 and counted[5, "byte_bpe_50k"] > 1


def test_compaction_leaves_the_base(spark, tmp_path):
    ddl = "source string, lang string, tokenizer_version string, n_before long, n_after long"
    store = token_counts.Rollup(spark, str(tmp_path / "store"))
    batch = lambda n: token_counts.signed_changes(spark.createDataFrame([("a", "en", "v", None, n)], ddl))
    held = lambda: sorted(n for n in os.listdir(tmp_path / "store/deltas"))
    totals = lambda: [tuple(r) for r in store.totals().collect()]
    store.compact()
    assert store.commit("1", batch(5)) and store.commit("2", batch(7))
    store.compact()
    assert held() == ["1", "2", "base-1"] and totals() == [("a", "en", "v", 2, 12)]  # a reader under way finds its rows
    assert not store.commit("1", batch(5)) and store.commit("3", batch(1))
    assert totals() == [("a", "en", "v", 3, 13)]
    store.compact()
    assert held() == ["3", "base-1", "base-2"] and totals() == [("a", "en", "v", 3, 13)]
    store.compact(grace=0)
    assert held() == ["base-2"] and sorted(os.listdir(tmp_path / "store/commits")) == ["base-1", "base-2"]
    assert totals() == [("a", "en", "v", 3, 13)]
    assert not any(store.commit(b, batch(9)) for b in "123")  # forgotten rows, remembered ids
    assert store.commit("4", batch(9)) and totals() == [("a", "en", "v", 4, 22)]
    with pytest.raises(ValueError):
        store.commit("base-3", batch(1))


def test_blocks_are_sent_in_bounded_batches():
    """One cell of many tiles, the last key of its input: its blocks do not pile up in one batch."""
    cell, n = 4913 * 8 + 289 * 8 + 17 * 8 + 8, 1 << 12
    fps = np.arange(n, dtype=np.int64)
    rows = pa.RecordBatch.from_arrays([pa.array(np.full(n, cell, np.int32)), pa.array(np.full(n, 999, np.int32)), pa.array(fps)], names=["cell", "tile", "fp"])
    sent = list(simhash._pack(3, {cell: 1000})(iter([rows])))
    assert sum(b.num_rows for b in sent) == 1000
    assert max(b.nbytes for b in sent) < 5 << 20
