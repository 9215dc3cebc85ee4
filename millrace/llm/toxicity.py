"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts drawn from all training documents, their
labels unread, are the unlabelled.
The classifier is linear over the hashed words and stems present in a text. With the class prior p, loss l
and scores g the risk is p E_P[l(g)] + max(0, E_U[l(-g)] - p E_P[l(-g)]): the unlabelled loss less
the part that toxic texts among them cause, never below zero. Where a batch drives that part
under zero, the step goes the other way, so that the classifier does not overfit the positives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.common import BYTE_VALUES, Names, as_bytes, held_out, mixed, slices, trainable, word_bounds
from millrace.llm.labels import in_tasks, labelled, sample

POSITIVES = 4_000
UNLABELLED = 12_000
_BITS = 18
_FEATURES = 512
_STEM = 5
_LEAST_TEXTS = 3
_LEAST_LIFT = 2.0
_LEAST_SIGMA = 5.0
_SLICE = 1 << 18


def _letters() -> np.ndarray:
    """Bytes that belong to a word here: letters, digits and all of UTF-8 beyond ASCII; A-Z are lowered."""
    lowered = np.zeros(256, dtype=np.uint8)
    for byte in range(256):
        if chr(byte).isascii():
            lowered[byte] = ord(chr(byte).lower()) if chr(byte).isalnum() else 0x20
        else:
            lowered[byte] = byte
    return lowered


_LOWER = _letters()


def word_buckets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word of a slice, and of its stem, the first few bytes."""
    low = _LOWER[data]
    starts, ends, rows = word_bounds(low, bounds)
    names = Names(BYTE_VALUES[0][low])
    stems = np.minimum(ends, starts + _STEM)
    both = np.r_[names.of(starts, ends), names.of(starts, stems) ^ np.uint64(0xA5A5A5A5)]
    return np.r_[rows, rows], (mixed(both) >> np.uint64(64 - _BITS)).astype(np.int64)


@dataclass
class Model:
    """Weight per hashed word (0 for words not chosen), and the offset of the score."""

    weights: np.ndarray
    offset: float

    def logits(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        rows, buckets = word_buckets(data, bounds)
        weights = self.weights[buckets]
        used = np.flatnonzero(weights)
        # A word counts once in a text, however often it stands there.
        seen = np.unique(rows[used] * (1 << _BITS) + buckets[used])
        return np.bincount(seen >> _BITS, self.weights[seen & ((1 << _BITS) - 1)], len(bounds) - 1) + self.offset


def _distinct_buckets(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The distinct hashed words of each text of a slice."""
    rows, buckets = word_buckets(data, bounds)
    seen = np.unique(rows * (1 << _BITS) + buckets)
    ends = np.searchsorted(seen >> _BITS, np.arange(len(bounds) - 1), "right")
    return np.split((seen & ((1 << _BITS) - 1)).astype(np.int32), ends[:-1]) if len(bounds) > 1 else []


def _presence(texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(Text, hashed word) pairs of texts given by their distinct hashed words, for some texts at a time."""
    for at in range(0, len(texts), 256):
        part = texts[at : at + 256]
        yield np.repeat(np.arange(at, at + len(part)), [len(t) for t in part]), np.concatenate(part).astype(np.int64)


def _dense(texts: list[np.ndarray], column: np.ndarray, width: int) -> np.ndarray:
    x = np.zeros((len(texts), width), dtype=np.float32)
    for rows, buckets in _presence(texts):
        known = column[buckets] >= 0
        x[rows[known], column[buckets[known]]] = 1
    return x


def distinct(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Training texts without most copies and near-copies: the first of those that share the least
    hash of their words under each of two orders. Else words of one much-copied text look telling."""
    least = np.full((2, len(texts)), np.iinfo(np.uint64).max, dtype=np.uint64)
    for rows, buckets in _presence(texts):
        for order, salt in zip(least, (11, 12)):
            np.minimum.at(order, rows, mixed(buckets.astype(np.uint64) * np.uint64(2 * salt + 1) + np.uint64(salt)))
    _, first = np.unique(least, axis=1, return_index=True)
    return [texts[i] for i in np.sort(first)]


def train(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = 200, seed: int = 5) -> Model:
    """Fit by Adam on the non-negative risk with the logistic loss; texts are given by their distinct hashed words.

    Without positives or unlabelled texts there is nothing to learn: every score is the prior.
    """
    prior = min(max(prior, 0.001), 0.9)
    positives, unlabelled = distinct(positives), distinct(unlabelled)
    flat = Model(np.zeros(1 << _BITS), float(np.log(prior / (1 - prior))))
    if not positives or not unlabelled:
        return flat
    counts = []
    for group in (positives, unlabelled):
        counts.append(sum(np.bincount(buckets, minlength=1 << _BITS) for _, buckets in _presence(group)))
    share_p = (counts[0] + 0.5) / (len(positives) + 1)
    share_u = (counts[1] + 0.5) / (len(unlabelled) + 1)
    # Words that stand in toxic texts mostly, by the prior, and more often than chance explains.
    chance = np.sqrt(share_u * (1 - share_u) / len(positives)).clip(1e-9)
    strength = (share_p - share_u) / chance
    strength[(counts[0] < _LEAST_TEXTS) | (share_p < _LEAST_LIFT * share_u)] = 0
    chosen = np.argsort(-strength, kind="stable")[:_FEATURES]
    chosen = chosen[strength[chosen] > _LEAST_SIGMA]
    if not len(chosen):
        return flat
    column = np.full(1 << _BITS, -1, dtype=np.int64)
    column[chosen] = np.arange(len(chosen))
    p, u = _dense(positives, column, len(chosen)), _dense(unlabelled, column, len(chosen))
    rng = np.random.default_rng(seed)
    w = np.zeros(len(chosen) + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    p, u = np.c_[p, np.ones(len(p), np.float32)], np.c_[u, np.ones(len(u), np.float32)]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    step = 0
    for _ in range(rounds):
        bp = p[rng.permutation(len(p))[:512]]
        bu = u[rng.permutation(len(u))[:2048]]
        gp, gu = bp @ w, bu @ w
        # log(1 + exp(-g)) for the class toxic, log(1 + exp(g)) for clean.
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        toward = -(prior * (1 - sigmoid(gp)) @ bp) / len(bp)
        away = (sigmoid(gu) @ bu) / len(bu) - prior * (sigmoid(gp) @ bp) / len(bp)
        grad = toward + away if negative >= 0 else -away
        grad = grad + 1e-4 * np.r_[w[:-1], 0]
        step += 1
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(1 << _BITS)
    weights[chosen] = w[:-1]
    return Model(weights, float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Learn from training rows only: at most `positives` toxic texts and `unlabelled` texts of any kind.

    The unlabelled texts are drawn from all training documents, their labels unread, so that the
    class prior, the share of toxic among all labelled training rows, holds for them.
    """
    known = labelled(docs, labels)
    shares = known.where(trainable(F.col("doc_id")) & F.col("_toxic").isNotNull()).agg(F.avg("_toxic")).first()[0]
    # Fetched as bytes of 32-bit numbers: a list of numbers would take ten times the room on the driver.
    hashed = in_tasks(lambda *part: [b.tobytes() for b in _distinct_buckets(*part)], pa.binary(), "binary", _SLICE)
    toxic = sample(docs, F.lit(1), positives, hashed, marks=known.where("_toxic = 1"))
    others = sample(docs, F.lit(0), unlabelled, hashed)
    groups = ([np.frombuffer(t, dtype=np.int32) for _, t in group] for group in (toxic, others))
    return train(*groups, float(shares or 0.0))


def score(spark: SparkSession, text: Column, model: Model) -> Column:
    """Probability that a text (as bytes) is toxic; whole texts, an empty one gets the offset alone."""
    shared = spark.sparkContext.broadcast(model)  # 2^18 weights, whatever the data

    @F.arrow_udf("double")
    def run(values: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([values], names=["t"])
        found = [shared.value.logits(data, bounds) for _, data, bounds in slices([batch], "t", _SLICE)]
        logits = np.concatenate(found) if found else np.empty(0)
        return pa.array(1 / (1 + np.exp(-np.clip(logits, -500, 500))))

    return run(text)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, held_out, score, predicted` for every row of `docs`, learnt from `labels.toxic`.

    Inputs of the score are the words of the whole text and nothing else. `predicted` is 1 from a
    score of 0.5. Null and empty texts have no words and get the score of none. Repeated rows are
    scored alike; a null id is neither held out nor learnt from. Labels without a document and
    null labels count for nothing; with no toxic label at all every score is the least prior.
    """
    model = fit(docs, labels)
    scored = docs.select("doc_id", score(docs.sparkSession, as_bytes("text"), model).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
