"""Quality by histogram gradient-boosted trees over statistics of a document.

Statistics are computed for whole texts inside tasks. Training bins each statistic by its
quantiles, grows trees of fixed depth from histograms of gradients, and stores all trees as flat
arrays; prediction walks all rows of a slice through one tree at a time by array indexing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.common import BYTE_VALUES, Names, as_bytes, held_out, slices, word_bounds
from millrace.llm.labels import in_tasks, labelled, sample

TRAIN_ROWS = 8_000
THRESHOLD = 0.3
_BINS = 64
_TREES = 60
_DEPTH = 4
_RATE = 0.15
_SLICE = 1 << 18

_CLASSES = {
    "upper": [*range(0x41, 0x5B)],
    "lower": [*range(0x61, 0x7B)],
    "digit": [*range(0x30, 0x3A)],
    "space": [0x20],
    "tab": [0x09],
    "line": [0x0A],
    "stop": [0x2E],
    "comma": [0x2C],
    "exclaim": [0x21],
    "bar": [0x7C],
    "symbol": [0x23, 0x24, 0x25, 0x26, 0x2A, 0x40, 0x5E, 0x7E, 0x3C, 0x3E, 0x3D, 0x2B, 0x5C, 0x5F, 0x60],
    "other": [0x22, 0x27, 0x28, 0x29, 0x2D, 0x2F, 0x3A, 0x3B, 0x3F, 0x5B, 0x5D, 0x7B, 0x7D],
    "control": [*range(0x00, 0x09), *range(0x0B, 0x20), 0x7F],
    "high": [*range(0x80, 0x100)],
}
_CLASS_OF = np.zeros(256, dtype=np.int64)
for _i, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[_bytes] = _i


def _per_row(rows: np.ndarray, names: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct names and count of the commonest name per row."""
    order = np.lexsort((names, rows))
    r, v = rows[order], names[order]
    new = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (v[1:] != v[:-1])]) if len(r) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[new, len(r)])
    most = np.zeros(n)
    np.maximum.at(most, r[new], sizes)
    return np.bincount(r[new], minlength=n), most


def statistics(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Statistics of the texts of a slice, one row per text; all are finite, also for empty texts."""
    n, kinds = len(bounds) - 1, len(_CLASSES)
    size = np.diff(bounds).astype(np.float64)
    row_of = np.repeat(np.arange(n), np.diff(bounds))
    shares = np.bincount(row_of * kinds + _CLASS_OF[data], minlength=n * kinds).reshape(n, kinds)
    starts, ends, rows = word_bounds(data, bounds)
    names = Names(BYTE_VALUES[0][data]).of(starts, ends)
    words = np.bincount(rows, minlength=n).astype(np.float64)
    lengths = (ends - starts).astype(np.float64)
    mean = np.bincount(rows, lengths, n) / np.maximum(words, 1)
    square = np.bincount(rows, lengths**2, n) / np.maximum(words, 1)
    distinct, most = _per_row(rows, names, n)
    pairs = np.flatnonzero(rows[1:] == rows[:-1]) if len(rows) else np.empty(0, np.int64)
    distinct_pairs, most_pairs = _per_row(rows[pairs], names[pairs] * np.uint64(3) + names[pairs + 1], n)
    odd_ends = np.bincount(rows, _CLASS_OF[data[ends - 1]] == list(_CLASSES).index("symbol"), n)
    lone = np.bincount(rows, (lengths == 1) & (_CLASS_OF[data[starts]] == list(_CLASSES).index("bar")), n)
    per_word, per_byte = np.maximum(words, 1), np.maximum(size, 1)
    return np.c_[
        shares / per_byte[:, None],
        np.log1p(size),
        np.log1p(words),
        mean,
        np.sqrt(np.maximum(square - mean**2, 0)),
        distinct / per_word,
        most / per_word,
        distinct_pairs / per_word,
        most_pairs / per_word,
        odd_ends / per_word,
        lone / per_word,
        shares[:, list(_CLASSES).index("line")] / per_word,
        shares[:, list(_CLASSES).index("upper")] / np.maximum(shares[:, :2].sum(axis=1), 1),
        shares[:, list(_CLASSES).index("stop")] / per_word,
        shares[:, list(_CLASSES).index("exclaim")] / per_word,
    ]


@dataclass
class Trees:
    """All trees as flat arrays: node i of a tree has children 2i + 1 and 2i + 2; leaves hold values."""

    features: np.ndarray  # trees x inner nodes
    limits: np.ndarray  # trees x inner nodes; a row goes right if its value is greater
    values: np.ndarray  # trees x leaves
    start: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total, every = np.full(len(x), self.start), np.arange(len(x))
        inner = self.features.shape[1]
        for feature, limit, value in zip(self.features, self.limits, self.values):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(_DEPTH):
                node = 2 * node + 1 + (x[every, feature[node]] > limit[node])
            total += value[node - inner]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -500, 500)))


def train(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost trees on the logistic loss; without rows of both labels every score is the (smoothed) share of 1."""
    inner, leaves = 2**_DEPTH - 1, 2**_DEPTH
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    trees = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), start)
    if len(np.unique(y)) < 2:
        return trees
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, _BINS + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)], axis=1)
    score = np.full(len(y), start)
    many = x.shape[1]
    offsets = np.arange(many) * _BINS
    parts = []
    for _ in range(_TREES):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for depth in range(_DEPTH):
            first, width = 2**depth - 1, 2**depth
            cell = ((node - first)[:, None] * many * _BINS + offsets + binned).ravel()
            g = np.bincount(cell, np.repeat(grad, many), width * many * _BINS).reshape(width, many, _BINS)
            h = np.bincount(cell, np.repeat(hess, many), width * many * _BINS).reshape(width, many, _BINS)
            gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            gr, hr = gt - gl, ht - hl
            gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - gt**2 / (ht + 1)
            gain[(hl < 1) | (hr < 1)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                f, b = divmod(int(best[k]), _BINS)
                if gain[k, f, b] > 1e-6 and b < len(cuts[f]):
                    feature[first + k], limit[first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > limit[node])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, leaves), np.bincount(leaf, hess, leaves)
        value = -_RATE * g / (h + 1)
        score += value[leaf]
        parts.append((feature, limit, value))
    return Trees(*(np.stack(z) for z in zip(*parts)), start)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Learn from at most `rows` labelled training rows, those with the least hash of their id; whole texts."""
    measured = in_tasks(lambda data, bounds: [row.tobytes() for row in statistics(data, bounds)], pa.binary(), "binary", _SLICE)
    taken = sample(docs, F.col("_quality"), rows, measured, marks=labelled(docs, labels))
    width = statistics(np.empty(0, np.uint8), np.array([0, 0])).shape[1]
    x = np.frombuffer(b"".join(row for _, row in taken)).reshape(len(taken), width)
    return train(x, np.array([label for label, _ in taken], dtype=np.float64))


def score(spark: SparkSession, text: Column, trees: Trees) -> Column:
    """Probability that a text (as bytes) is of good quality, from statistics of the whole text."""
    shared = spark.sparkContext.broadcast(trees)

    @F.arrow_udf("double")
    def run(values: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([values], names=["t"])
        found = [shared.value.probability(statistics(d, b)) for _, d, b in slices([batch], "t", _SLICE)]
        return pa.array(np.concatenate(found) if found else np.empty(0))

    return run(text)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id, held_out, score, predicted` for every row of `docs`, learnt from `labels.quality`.

    The score is the probability of label 1; `predicted` is 1 from `threshold` on. Null texts count
    as empty; empty texts get the score of their (all zero) statistics. Repeated rows are scored
    alike; a null id is neither held out nor learnt from. Null labels and labels without a document
    count for nothing; with no label, or one kind of label only, every score is the same.
    """
    trees = fit(docs, labels)
    scored = docs.select("doc_id", score(docs.sparkSession, as_bytes("text"), trees).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
