"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the whole text alone (never its id, language, source or
label).  The model is fitted on at most ``max_rows`` labelled rows (a documented
bound: a sample by the hash of their id), whose statistics, some 30
numbers a row, go to the driver.  Every document is scored inside Spark tasks by
walking the flattened trees for a whole batch at a time.

Defined cases: a null text counts as empty and is scored; labels without an id
or a value are not used, and of repeated labels the largest counts; without any
usable label every score is 0.5; an empty table gives no rows; other columns
are not read by ``scores`` and pass through ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import byte_rows, map_arrow

MAX_ROWS = 20_000
THRESHOLD = 0.3
BINS = 64

_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
    "space": b" ", "newline": b"\n", "stop": b".", "comma": b",", "bang": b"!?", "bar": b"|",
    "symbol": b"#$%&*~^=+<>@\\_", "bracket": b"()[]{}", "quote": b"\"'`", "dash": b"-/:;",
}
_SELECT = np.zeros((256, len(_CLASSES) + 1))
for _i, _c in enumerate(_CLASSES.values()):
    _SELECT[list(_c), _i] = 1
_SELECT[128:, -1] = 1


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a text's form."""
    size = len(text)
    shares = (np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _SELECT) / max(size, 1)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n, lengths = max(len(words), 1), np.fromiter(map(len, words), np.int64, len(words))
    unique, long_lines = set(words), [len(x) for x in lines]
    ends = sum(w[-1] in b".!?" for w in unique) / max(len(unique), 1)
    upper = sum(w.isupper() for w in unique) / max(len(unique), 1)
    alpha = sum(w.isalpha() for w in unique if w.isascii()) / max(len(unique), 1)
    pairs = len(set(zip(words, words[1:]))) / max(len(words) - 1, 1)
    return [
        np.log1p(size), np.log1p(len(words)), *shares.tolist(),
        float(lengths.mean()) if len(words) else 0.0, float(lengths.std()) if len(words) else 0.0,
        float((lengths <= 3).sum()) / n, float((lengths >= 14).sum()) / n,
        len(unique) / n, pairs, ends, upper, alpha,
        np.log1p(len(lines)), len(set(lines)) / max(len(lines), 1),
        float(np.mean(long_lines)) if lines else 0.0, max(long_lines, default=0) / max(size, 1),
    ]


N_STATISTICS = len(statistics(b""))


@dataclass
class Trees:
    """Flattened trees: node k of all trees has a feature (-1: leaf), a threshold, children and a value."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of statistics: all trees and rows go down a level at a time."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            down = np.where(x[rows, np.maximum(f, 0)] <= self.threshold[at], self.left[at], self.right[at])
            at = np.where(f < 0, at, down)
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def _leafless(base: float) -> Trees:
    zero = np.zeros(0, np.int64)
    return Trees(zero, zero, zero.astype(float), zero, zero, zero.astype(float), base, 0)


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.1, least: int = 5, penalty: float = 1.0) -> Trees:
    """Fit trees on gradient histograms of binned statistics, level by level."""
    if not len(y) or not np.ptp(y):
        p = 0.5 if not len(y) else (len(y) * y[0] + 1) / (len(y) + 2)
        return _leafless(float(np.log(p / (1 - p))))
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], axis=1)
    flat = binned + np.arange(width) * BINS
    base = float(np.log(y.mean() / (1 - y.mean())))
    raw = np.full(n, base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        for column, empty in ((feature, -1), (threshold, 0.0), (left, 0), (right, 0), (value, 0.0)):
            column.append(empty)
        return len(feature) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        level = [(node(), np.arange(n))]
        roots.append(level[0][0])
        for d in range(depth + 1):
            below = []
            for k, rows in level:
                sg, sh = g[rows].sum(), h[rows].sum()
                value[k] = -rate * sg / (sh + penalty)
                if d == depth or len(rows) < 2 * least:
                    raw[rows] += value[k]
                    continue
                at = flat[rows].ravel()
                hist = [np.bincount(at, w, width * BINS).reshape(width, BINS).cumsum(axis=1)
                        for w in (np.repeat(g[rows], width), np.repeat(h[rows], width), None)]
                lg, lh, ln = hist
                gain = lg**2 / (lh + penalty) + (sg - lg)**2 / (sh - lh + penalty) - sg**2 / (sh + penalty)
                gain[(ln < least) | (len(rows) - ln < least)] = -1
                f, b = divmod(int(gain.argmax()), BINS)
                if gain[f, b] <= 1e-9 or b >= len(cuts[f]):
                    raw[rows] += value[k]
                    continue
                goes = binned[rows, f] <= b
                feature[k], threshold[k], value[k] = f, float(cuts[f][b]), 0.0
                left[k], right[k] = node(), node()
                below += [(left[k], rows[goes]), (right[k], rows[~goes])]
            level = below
    return Trees(np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), base, depth)


def _matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(-1, N_STATISTICS)


def _sample_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.array(statistics(t), float).tobytes() for t in byte_rows(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["id", "label", "x"])


def held_out(id_col) -> F.Column:
    """True for the fifth of the ids that is never learnt from."""
    return F.crc32(id_col.cast("string")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_rows: int = MAX_ROWS, **settings) -> Trees:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fifth."""
    usable = labels.select(F.col(id_col).cast("long").alias("lid"), F.col(label_col).cast("int").alias("label")).dropna()
    usable = usable.filter(~held_out(F.col("lid"))).groupBy("lid").agg(F.max("label").alias("label"))
    # A share by hash first, so that the ordered cut gets little more than max_rows rows however many are labelled.
    share = 1.5 * max_rows / max(1, usable.count())
    thinned = usable if share >= 1 else usable.filter(F.pmod(F.xxhash64("lid"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = thinned.orderBy(F.xxhash64("lid"), "lid").limit(max_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    learnt = texts.join(F.broadcast(sample), F.col("id") == F.col("lid"))  # at most max_rows pairs of numbers
    rows = (map_arrow(learnt.select("id", "label", "text"), _sample_statistics, "id long, label int, x binary")
            .groupBy("id").agg(F.max("label").alias("label"), F.max("x").alias("x")).collect())  # of repeated ids one
    rows.sort(key=lambda r: (r["id"], r["x"]))
    x = np.array([np.frombuffer(r["x"]) for r in rows]).reshape(-1, N_STATISTICS)
    return boost(x, np.array([float(r["label"]) for r in rows]), **settings)


def _scorer(model: Trees, at: int, keep: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.predict(_matrix(byte_rows(batch.column(at))))
            if keep is None:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])
            else:
                yield batch.filter(pa.array(score >= keep))
    return run


def scores(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score."""
    return map_arrow(docs.select(F.col(id_col).cast("long"), F.col(text_col)), _scorer(model, 1, None), "doc_id long, score double")


def accepted(docs: DataFrame, model: Trees, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score is at least ``threshold``, whole; no shuffle."""
    columns = [f"c{i}" for i in range(len(docs.columns))]
    by_place = docs.toDF(*columns)
    return map_arrow(by_place, _scorer(model, docs.columns.index(text_col), threshold), by_place.schema).toDF(*docs.columns)
