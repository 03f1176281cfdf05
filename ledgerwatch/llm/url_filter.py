"""URL filters by a sort-merge range join.

A url's key is its reversed host, each label closed by U+0000, then its path:
``www.example.com/en/1`` is ``com\\0example\\0www\\0/en/1``.  A rule (host, path)
fits its host and all subdomains when the url's path starts with the rule's.
Its host prefix becomes the interval of keys that begin with it, and intervals
of rules nest.  Urls and rules are sorted by key; one sweep keeps a stack of
the host intervals that contain the current key, each with its rules by path.
The longest fitting rule (host and path together) wins, of equally long ones
``block``, then the smaller rule.

Keys are cut into ranges at quantiles of a bounded sample of urls (it sets the
balance, never the result).  A rule is sent to every range that its interval
touches, so a range needs no other range's stack.  A key that fills several
quantiles (one url in a third of all rows) is a boundary several times over;
its rows are dealt over all those ranges.

Defined cases: a null url, or one without ``://``, has an empty host and path;
a url without a fitting rule takes the method's default verdict ``allow``; an
empty path fits only rules with an empty path; a rule without a host fits every
url by its path; null parts of rules count as empty and repeated rules as one;
empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_arrow

#: The rules of the registered query: host, path, verdict (fixed values).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
DEFAULT = "allow"
#: Sampled urls per range; with at most ``MAX_RANGES`` ranges the driver holds at most 204,800 keys.
SAMPLE, MAX_RANGES = 50, 4096
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    rest = F.coalesce(F.regexp_extract(rest, r"^[^?#]*", 0), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/]*", 0), _UPPER, _LOWER)
    return host, F.substring(rest, F.length(host) + 1, F.length(rest))


def host_key(host: str) -> str:
    """``a.b.c`` as ``c\\0b\\0a\\0``; the empty host as the empty key."""
    return "".join(label + "\0" for label in reversed(host.split("."))) if host else ""


def _above(prefix: str) -> str | None:
    """The smallest key behind all keys that begin with ``prefix`` (None: no end)."""
    return prefix[:-1] + "\1" if prefix else None


class Level:
    """An open host interval: its rules by path."""

    def __init__(self, prefix: str):
        self.prefix, self.rules, self.lengths = prefix, {}, []

    def add(self, host: str, path: str, verdict: str):
        now = self.rules.get(path)
        if now is None:
            self.lengths = sorted({*self.lengths, len(path)}, reverse=True)
        if now is None or verdict == "block":
            self.rules[path] = (host, verdict)

    def best(self, path: str):
        for n in self.lengths:
            if n <= len(path) and (found := self.rules.get(path[:n])):
                return n, found[0], path[:n], found[1]
        return None


def fitting(stack: list[Level], path: str) -> tuple[str, str] | None:
    """Rule and verdict of the longest rule on the stack that fits ``path``."""
    best = None
    for level in stack:
        if found := level.best(path):
            n, host, rule_path, verdict = found
            rank = (len(host) + n, verdict == "block")
            if best is None or rank > best[0] or rank == best[0] and host + rule_path < best[1]:
                best = (rank, host + rule_path, verdict)
    return best and best[1:]


_IN = "range int, key string, is_url int, page_id long, host string, path string, verdict string"
_OUT = "page_id long, host string, path string, rule string, verdict string"


def _sweep(default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[Level] = []
        current = None
        for batch in batches:
            out = []
            for at, key, is_url, page, host, path, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                if at != current:
                    stack, current = [], at
                while stack and not key.startswith(stack[-1].prefix):
                    stack.pop()
                if is_url:
                    found = fitting(stack, path) or (None, default)
                    out.append((page, host, path, *found))
                else:
                    if not stack or stack[-1].prefix != key:
                        stack.append(Level(key))
                    stack[-1].add(host, path, verdict)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), *[pa.string()] * 4))],
                                                 names=["page_id", "host", "path", "rule", "verdict"])
    return run


def _dealt(bounds: list[str]):
    """Adds the range of a url: of those a repeated boundary spans, one by the row's hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges, keys = [], []
            for host, path, h in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                key = host_key(host) + path
                low, high = bisect_left(bounds, key), bisect_right(bounds, key)
                ranges.append(low + h % (high - low + 1))
                keys.append(key)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges, pa.int32()), pa.array(keys, pa.string()), pa.array([1] * n, pa.int32()), *batch.columns[:3], pa.nulls(n, pa.string())],
                names=["range", "key", "is_url", "page_id", "host", "path", "verdict"])
    return run


def _spread(bounds: list[str]):
    """A rule once per range that its interval touches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, path, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                prefix = host_key(host)
                end = _above(prefix)
                last = len(bounds) if end is None else bisect_left(bounds, end)
                rows += [(k, prefix, 0, None, host, path, verdict) for k in range(bisect_left(bounds, prefix), last + 1)]
                if len(rows) >= 8192:
                    yield _rules(rows)
                    rows = []
            if rows:
                yield _rules(rows)
    return run


def _rules(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["range", "key", "is_url", "page_id", "host", "path", "verdict"])


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT,
          ranges: int | None = None) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict.  ``rules`` has host, path and verdict."""
    spark = pages.sparkSession
    ranges = min(ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), MAX_RANGES)
    host, path = host_path(F.col(url_col))
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("h", F.pmod(F.xxhash64("page_id", "path"), F.lit(MAX_RANGES)))
    share = min(1.0, SAMPLE * ranges / max(1, pages.count()))  # about SAMPLE urls a range, whatever the table's size
    sample = sorted(host_key(r["host"]) + r["path"] for r in urls.select("host", "path").sample(share, 7).toLocalIterator())
    bounds = [sample[len(sample) * k // ranges] for k in range(1, ranges)] if sample else []
    wanted = rules.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("host", "path", "verdict")))
    wanted = wanted.withColumn("host", F.translate("host", _UPPER, _LOWER)).distinct()
    both = map_arrow(urls, _dealt(bounds), _IN).unionByName(map_arrow(wanted, _spread(bounds), _IN))
    met = both.repartition(ranges, "range").sortWithinPartitions("range", "key", "is_url")
    return map_arrow(met, _sweep(default), _OUT)


def rule_table(spark, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")
