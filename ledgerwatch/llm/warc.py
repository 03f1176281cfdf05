"""WARC derivatives: linked metadata and plain-text conversion records of responses.

Each response gives a ``metadata`` record (header fields of its HTTP response
and facts about its payload) and a ``conversion`` record (its text), both with
``WARC-Refers-To`` naming the response, its target URI and date, the payload's
digest, and digests of their own blocks.  The payload is the body without its
transfer coding (chunks); its text is read behind the content codings gzip,
deflate and x-gzip.  Record ids are derived from the
response's id and the record's type, so a task that runs again writes the same
records.

Defined cases: a null block counts as empty, a block without an empty line as
header only; a head that is not closed ends where the body begins; a response without a record id gets one from its URI and payload;
a missing URI leaves the field out, and its controls and spaces are percent-encoded there; a missing date is that of the response's
``Date`` field, else ``default_date``; a body whose coding is broken is decoded as far as it goes, one in an unknown coding has no text;
repeated rows give repeated records
of the same ids; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import datetime as dt
import email.utils
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import byte_rows, map_arrow

VERSION = "WARC/1.1"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
_OPENS = re.compile(r"<!--|<(script|style|noscript|template|head)\b", re.I)
_IN_HEAD = re.compile(r"(<!--)|(</head\s*>)|<(title|script|style|noscript|template)\b|(<(?:meta|link|base)\b[^>]*(?:>|\Z))|</?(?:body|head|p|div|br|li|ul|ol|table|tr|td|th|"
                      r"h[1-6]|article|section|nav|header|footer|aside|main|blockquote|pre|form|dl|dt|dd|hr)\b", re.I)
_CLOSES = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("title", "script", "style", "noscript", "template")} | {"": re.compile("-->")}
_BLOCK = re.compile(r"</?(?:p|div|br|li|ul|ol|table|tr|td|th|h[1-6]|article|section|nav|header|footer|aside|main|blockquote|pre|form|dl|dt|dd|hr|title)\b[^>]*(?:>|\Z)", re.I)
_TAG = re.compile(r"<[/!?a-zA-Z][^>]*(?:>|\Z)")


def digest(data: bytes) -> str:
    """``sha1:`` and base 32, as WARC files label digests."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(31).join(parts))}>"


def split_response(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, header fields in their order, and payload of an HTTP response."""
    head, _, payload = block.partition(b"\r\n\r\n")
    first, *rest = head.decode("iso-8859-1").split("\r\n")
    fields: list[tuple[str, str]] = []
    for line in rest:
        if line[:1] in " \t" and fields:  # a folded line
            fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            fields.append((name.strip(), value.strip()))
    return first, fields, payload


_CHUNK = re.compile(rb"\s*([0-9a-fA-F]+)[^\r\n]*\r?\n")


def without_chunks(body: bytes) -> bytes:
    """A chunked body's payload: up to the last chunk, or as far as the chunks go; a body that does not begin with one as it is."""
    parts, at = [], 0
    while m := _CHUNK.match(body, at):
        size = int(m[1], 16)
        if not size:
            return b"".join(parts)
        parts.append(body[m.end():m.end() + size])
        at = m.end() + size
    return b"".join(parts) if parts else body


def decoded(payload: bytes, codings: str) -> bytes:
    """The payload behind its content codings, as far as they can be read."""
    for coding in reversed([c.strip().lower() for c in codings.split(",") if c.strip()]):
        if coding == "identity":
            continue
        if coding not in ("gzip", "x-gzip", "deflate"):
            return b""
        if coding == "deflate" and payload[:1] and payload[0] & 15 != 8:
            payload = _inflated(payload, -zlib.MAX_WBITS)  # without the zlib header, as some servers send it
        else:
            payload = _inflated(payload, zlib.MAX_WBITS | (0 if coding == "deflate" else 16))
    return payload


def _inflated(data: bytes, bits: int) -> bytes:
    parts = []
    while data:  # gzip members in a row
        stream = zlib.decompressobj(bits)
        try:
            for at in range(0, len(data), 1 << 16):
                parts.append(stream.decompress(data[at:at + (1 << 16)]))
                if stream.eof:
                    break
            parts.append(stream.flush())
        except zlib.error:
            break
        data = stream.unused_data + data[at + (1 << 16):] if stream.eof else b""
    return b"".join(parts)


_CONTROLS = re.compile(r"[\x00-\x20\x7f]")


def header_uri(uri: str) -> str:
    """The URI as a header field can hold it."""
    return _CONTROLS.sub(lambda m: f"%{ord(m[0]):02X}", uri)


def _one_line(value: str) -> str:
    return _CONTROLS.sub(" ", value).strip()


def http_date(value: str) -> str | None:
    """A ``Date`` field as WARC-Date; null if it is none."""
    try:
        found = email.utils.parsedate_to_datetime(value)
    except (TypeError, ValueError):
        return None
    return found.astimezone(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ") if found.tzinfo else found.strftime("%Y-%m-%dT%H:%M:%SZ")


def plain_text(payload: bytes, content_type: str) -> str:
    """The payload as text: of HTML one line per block without markup, else the decoded payload."""
    charset = re.search(r"charset=[\"']?([\w.:-]+)", content_type, re.I)
    try:
        text = payload.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        text = payload.decode("utf-8", "replace")
    if "html" not in content_type.lower():
        return text
    text = html.unescape(_TAG.sub("", _BLOCK.sub("\n", _without_hidden(text))))
    return "\n".join(line for x in text.split("\n") if (line := " ".join(x.split())))


def _without_hidden(page: str) -> str:
    """The page without comments, scripts, styles, closed noscript and template elements, and its head.

    A comment, script or style that is not closed goes on to the end of the page, as in a browser; a noscript or
    template that is not closed hides nothing.
    """
    kept, at, unclosed = [], 0, set()

    def end_of(name: str, start: int) -> int | None:
        m = None if name in unclosed else _CLOSES[name].search(page, start)
        if m is None:
            unclosed.add(name)
        return m and m.end()

    def end_of_head(start: int) -> int:
        """Behind ``</head>``, or behind the last element that can only stand in a head if the body begins without."""
        last = start
        while m := _IN_HEAD.search(page, start):
            if m[2]:
                return m.end()
            end = m.end() if m[4] else end_of((m[3] or "").lower(), m.end()) if m[1] or m[3] else None
            if end is None:
                return last
            start = last = end
        return last

    while m := _OPENS.search(page, at):
        name = (m[1] or "").lower()
        if name == "head":
            close = page.find(">", m.end())
            end = end_of_head(close + 1) if close >= 0 else len(page)
        else:
            end = end_of(name, m.end())
            if end is None:
                end = m.start() if name in ("noscript", "template") else len(page)
        kept += [page[at:m.start()], "\n"]
        if end == m.start():  # the tag itself goes with the other markup
            kept.append(page[end:m.end()])
            end = m.end()
        at = end
    return "".join([*kept, page[at:]])


def derivatives(rid: str | None, uri: str | None, date: str | None, block: bytes, default_date: str) -> Iterator[tuple]:
    """(type, header fields, block) of the metadata and the conversion record of one response."""
    status, fields, payload = split_response(block)
    status, fields = _one_line(status), [(_one_line(k), _one_line(v)) for k, v in fields]
    field = lambda name, default: next((v for k, v in fields if k.lower() == name), default)
    if field("transfer-encoding", "").lower().split(",")[-1].strip() == "chunked":
        payload = without_chunks(payload)
    payload_digest = digest(payload)
    rid = _one_line(rid or "") or record_id("response", uri or "", payload_digest)
    date = _one_line(date or "") or http_date(field("date", "")) or default_date
    codings = ",".join(v for k, v in fields if k.lower() == "content-encoding")
    text = plain_text(decoded(payload, codings), field("content-type", "application/octet-stream")).encode("utf-8")
    about = [("status", status), *((f"header-{k.lower()}", v) for k, v in fields), ("payload-digest", payload_digest),
             ("payload-length", str(len(payload))), ("text-length", str(len(text)))]
    body = "".join(f"{k}: {v}\r\n" for k, v in about).encode("utf-8")
    for kind, kind_type, data in (("metadata", "application/warc-fields", body), ("conversion", "text/plain; charset=utf-8", text)):
        header = [("WARC-Type", kind), ("WARC-Record-ID", record_id(kind, rid)), ("WARC-Refers-To", rid)]
        header += [("WARC-Target-URI", header_uri(uri))] if uri else []
        header += [("WARC-Date", date), ("WARC-Payload-Digest", payload_digest), ("WARC-Block-Digest", digest(data)), ("Content-Type", kind_type),
                   ("Content-Length", str(len(data)))]
        yield kind, header, data


def serialise(header: list[tuple[str, str]], data: bytes) -> bytes:
    """A record as it stands in a WARC file."""
    return (VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in header) + "\r\n").encode("utf-8") + data + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Header fields and block of every record of a WARC file's bytes (plain, or one gzip member per record)."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
        header = [(k, v.strip()) for k, _, v in (x.partition(":") for x in lines)]
        size = int(next(v for k, v in header if k.lower() == "content-length"))
        yield header, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


_DDL = ("source_id long, record_type string, record_id string, refers_to string, target_uri string, content_type string, "
        "payload_digest string, block_digest string, content_length long, header string, block string")
_TYPES = (pa.int64(), *[pa.string()] * 7, pa.int64(), pa.string(), pa.string())
_NAMES = [x.split()[0] for x in _DDL.split(", ")]


def _build(default_date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for source, rid, uri, date, block in zip(*(batch.column(k).to_pylist() for k in range(4)), byte_rows(batch.column(4))):
                for kind, header, data in derivatives(rid, uri, date, block, default_date):
                    of = dict(header)
                    rows.append((source, kind, of["WARC-Record-ID"], of["WARC-Refers-To"], uri, of["Content-Type"], of["WARC-Payload-Digest"],
                                 of["WARC-Block-Digest"], len(data), "".join(f"{k}: {v}\r\n" for k, v in header), data.decode("utf-8", "replace")))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)
    return run


def build(responses: DataFrame, default_date: str | None = None) -> DataFrame:
    """Two records per row of ``responses`` (source_id, record_id, target_uri, warc_date, block binary).  No shuffle.

    ``default_date`` (default: the time of this call) dates responses that carry no date.
    """
    default_date = default_date or dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    cols = [F.col("source_id").cast("long"), *(F.col(c).cast("string") for c in ("record_id", "target_uri", "warc_date")), F.col("block").cast("binary")]
    return map_arrow(responses.select(*cols), _build(default_date), _DDL)


def responses_of(pages: DataFrame, warc_date: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages as HTTP responses: a status line, header fields and the page as payload."""
    body = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.length(body).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(F.col(id_col).alias("source_id"), F.lit(None).cast("string").alias("record_id"), F.col(url_col).alias("target_uri"),
                        F.lit(warc_date).cast("string").alias("warc_date"), F.concat(F.encode(head, "UTF-8"), body).alias("block"))


def record_bytes(records: DataFrame, compress: bool = True) -> DataFrame:
    """``source_id`` and ``record``: the bytes of a WARC file with this one record; members can be concatenated."""
    def run(batches):
        for batch in batches:
            out = []
            for header, block in zip(byte_rows(batch.column(1)), byte_rows(batch.column(2))):
                data = f"{VERSION}\r\n".encode() + header + b"\r\n" + block + b"\r\n\r\n"
                out.append(gzip.compress(data, mtime=0) if compress else data)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["source_id", "record"])
    return map_arrow(records.select("source_id", "header", "block"), run, "source_id long, record binary")
