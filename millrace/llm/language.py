"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word byte by byte from both ends and labels every byte; its states start anew
at each word. A document's probabilities are the mean over all bytes of its words. As equal words
get equal labels, each distinct word of a slice is read once and counted as often as it stands
there. Training is numpy too: backpropagation through time over words of labelled documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.common import BYTE_VALUES, Names, as_bytes, held_out, mixed, slices, word_bounds
from millrace.llm.labels import in_tasks, sample

TRAIN_ROWS = 20_000
ROWS_PER_LANGUAGE = 200
WORD_BYTES = 1_500
UNKNOWN = "und"
_HIDDEN = 20
_LONGEST = 16
_BATCH = 4_096
_SLICE = 1 << 22

# The ASCII letters.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Network:
    """Weights of both directions and of the labels; direction 1 reads from the end."""

    labels: list[str]
    byte: np.ndarray  # 2 x 256 x 3H: what a byte adds to the update, reset and candidate gates
    state: np.ndarray  # 2 x H x 3H
    out: np.ndarray  # 2H + 1 x labels

    @classmethod
    def fresh(cls, labels: list[str], rng: np.random.Generator) -> Network:
        h = _HIDDEN
        return cls(
            labels,
            rng.normal(0, 0.3, (2, 256, 3 * h)).astype(np.float32),
            rng.normal(0, 1 / np.sqrt(h), (2, h, 3 * h)).astype(np.float32),
            rng.normal(0, 0.1, (2 * h + 1, len(labels))).astype(np.float32),
        )

    def read(self, words: np.ndarray, sizes: np.ndarray, keep: bool = False):
        """States at every byte (n x time x 2H) of words padded at their end; the gates if asked."""
        n, time = words.shape
        h = _HIDDEN
        states = np.zeros((n, time, 2 * h), dtype=np.float32)
        gates = []
        for d in (0, 1):
            now = np.zeros((n, h), dtype=np.float32)
            for t in range(time) if d == 0 else range(time - 1, -1, -1):
                live = (t < sizes)[:, None]
                x = self.byte[d][words[:, t]]
                u = now @ self.state[d]
                zr = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
                new = np.where(live, z * now + (1 - z) * c, now)
                if keep:
                    gates.append((d, t, live, now, z, r, c, u[:, 2 * h :]))
                now = new
                states[:, t, d * h : d * h + h] = now
        return (states, gates) if keep else states

    def label(self, states: np.ndarray) -> np.ndarray:
        """Probabilities of the labels at every byte."""
        logits = states @ self.out[:-1] + self.out[-1]
        e = np.exp(logits - logits.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def gradients(self, words: np.ndarray, sizes: np.ndarray, target: np.ndarray):
        """Gradients of the mean cross-entropy over all bytes, by backpropagation through time."""
        h = _HIDDEN
        states, gates = self.read(words, sizes, keep=True)
        p = self.label(states)
        mask = (np.arange(words.shape[1]) < sizes[:, None])[..., None]
        p[np.arange(len(words)), :, target] -= 1
        error = (p * mask / max(1, sizes.sum())).astype(np.float32)
        flat, flat_error = states.reshape(-1, 2 * h), error.reshape(-1, error.shape[-1])
        out = np.r_[flat.T @ flat_error, flat_error.sum(axis=0)[None]]
        back = error @ self.out[:-1].T
        byte, state = np.zeros_like(self.byte), np.zeros_like(self.state)
        carry, direction = None, None
        for d, t, live, before, z, r, c, uc in reversed(gates):
            if d != direction:
                carry, direction = np.zeros((len(words), h), dtype=np.float32), d
            carry = carry + back[:, t, d * h : d * h + h]
            g = np.where(live, carry, 0)
            dc = g * (1 - z) * (1 - c * c)
            dz = g * (before - c) * z * (1 - z)
            dr = dc * uc * r * (1 - r)
            np.add.at(byte[d], words[:, t], np.concatenate([dz, dr, dc], axis=1))
            du = np.concatenate([dz, dr, dc * r], axis=1)
            state[d] += before.T @ du
            carry = np.where(live, g * z + du @ self.state[d].T, carry)
        return byte, state, out


def _pack(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    words = np.zeros((len(starts), int(sizes.max(initial=1))), dtype=np.uint8)
    at = starts[:, None] + np.arange(words.shape[1])
    inside = np.arange(words.shape[1]) < sizes[:, None]
    words[inside] = data[at[inside]]
    return words


def _pieces(starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, those over 16 bytes in parts of 16."""
    many = np.maximum(1, -(-(ends - starts) // _LONGEST))
    of = np.repeat(np.arange(len(starts)), many)
    first = starts[of] + _LONGEST * (np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many))
    return first, np.minimum(first + _LONGEST, ends[of]), rows[of]


def train(examples: list[tuple[str, bytes]], steps: int = 350, batch: int = 384, seed: int = 3) -> Network:
    """Fit by Adam on words of labelled texts; labels are drawn evenly, words of a label at random."""
    labels = sorted({label for label, _ in examples})
    rng = np.random.default_rng(seed)
    network = Network.fresh(labels, rng)
    if len(labels) < 2:
        return network
    data = np.frombuffer(b" ".join(t for _, t in examples), np.uint8)
    bounds = np.cumsum([0, *(len(t) + 1 for _, t in examples)])
    bounds[-1] -= 1
    starts, ends, rows = _pieces(*word_bounds(data, bounds))
    of = np.array([labels.index(label) for label, _ in examples])[rows]
    pools = [np.flatnonzero(of == k) for k in range(len(labels))]
    pools = [pool for pool in pools if len(pool)]
    weights = [network.byte, network.state, network.out]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(pool, max(1, batch // len(pools))) for pool in pools])
        sizes = ends[pick] - starts[pick]
        grads = network.gradients(_pack(data, starts[pick], sizes), sizes, of[pick])
        rate = 0.02 * (1 - step / (steps + 1))
        for w, g, (m, v) in zip(weights, grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return network


def _drawn_words(data: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Of each text, words from all over it, drawn by a hash of word and place, in the order of the text.

    About `WORD_BYTES` of them; all, if the text has no more. Training picks its words at random from these.
    """
    starts, ends, rows = _pieces(*word_bounds(data, bounds))  # what the network reads at a time
    lot = mixed(Names(BYTE_VALUES[0][data]).of(starts, ends) ^ mixed((starts - bounds[rows]).astype(np.uint64)))
    order = np.lexsort((lot, rows))
    used = np.cumsum((ends - starts + 1)[order])
    before = np.r_[0, used][np.searchsorted(rows, np.arange(len(bounds) - 1))]
    chosen = np.sort(order[used - before[rows[order]] <= WORD_BYTES])
    out: list[list[bytes]] = [[] for _ in range(len(bounds) - 1)]
    raw = data.tobytes()
    for s, e, r in zip(starts[chosen].tolist(), ends[chosen].tolist(), rows[chosen].tolist()):
        out[r].append(raw[s:e])
    return [b" ".join(words) for words in out]


def _has_letter(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a text holds a letter of any script."""
    sums = np.r_[0, np.cumsum(_LETTER[data])]
    found = sums[bounds[1:]] > sums[bounds[:-1]]
    for row in np.flatnonzero(~found & (bounds[1:] > bounds[:-1])):
        text = data[bounds[row] : bounds[row + 1]].tobytes().decode("utf-8", "ignore")
        found[row] = any(c.isalpha() for c in text)
    return found


def document_probabilities(network: Network, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean label probabilities over the bytes of each text; zeros for texts without words."""
    starts, ends, rows = _pieces(*word_bounds(data, bounds))
    n, k = len(bounds) - 1, len(network.labels)
    if not len(starts) or not k:
        return np.zeros((n, k))
    sizes = ends - starts
    names = Names(BYTE_VALUES[0][data]).of(starts, ends)
    _, first, which = np.unique(names, return_index=True, return_inverse=True)
    first = first[order := np.argsort(sizes[first], kind="stable")]
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    sums = np.zeros((len(first), k))
    for s in range(0, len(first), _BATCH):
        part = first[s : s + _BATCH]
        p = network.label(network.read(_pack(data, starts[part], sizes[part]), sizes[part]))
        mask = np.arange(p.shape[1]) < sizes[part][:, None]
        sums[s : s + _BATCH] = (p * mask[..., None]).sum(axis=1)
    which = place[which]
    total = np.stack([np.bincount(rows, sums[which, j], n) for j in range(k)], axis=1)
    return total / np.maximum(np.bincount(rows, sizes, n), 1)[:, None]


def predict(spark: SparkSession, text: Column, network: Network) -> Column:
    """`lang_pred, score` of a text (as bytes; null allowed)."""
    shared = spark.sparkContext.broadcast(network)  # some 35,000 weights, whatever the data

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def run(values: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([values], names=["t"])
        labels, scores = [], []
        for _, data, bounds in slices([batch], "t", _SLICE):
            p = document_probabilities(shared.value, data, bounds)
            known = _has_letter(data, bounds)
            for row in range(len(bounds) - 1):
                sure = known[row] and p.shape[1] > 0
                best = int(p[row].argmax()) if sure else 0
                labels.append(shared.value.labels[best] if sure else UNKNOWN)
                scores.append(min(1.0, float(p[row, best])) if sure else 0.0)
        return pa.StructArray.from_arrays(
            [pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"]
        )

    return run(text)


def languages(docs: DataFrame, rows: int = TRAIN_ROWS, per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """`doc_id, held_out, lang_pred, score` for every row of `docs`.

    Learns from text and language of at most `per_language` training documents of each language, those with the
    least hash of their id, and of at most `rows` in all; of each, words drawn from the whole text; predictions read the whole text and nothing else. `score` is the mean probability
    of the predicted language over all bytes of the text.

    `und` with score 0 stands for null texts and texts without a letter (empty, blank, digits), and
    for all texts if there is no labelled document. Repeated rows are predicted alike; a null id is
    neither held out nor learnt from; null languages are not learnt from.
    """
    drawn = in_tasks(_drawn_words, pa.binary(), "binary", _SLICE)
    taken = sample(docs, F.col("lang"), rows, drawn, per_label=per_language)
    network = train([(str(label), bytes(words)) for label, words in taken])
    found = docs.select("doc_id", predict(docs.sparkSession, as_bytes("text"), network).alias("_found"))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_found.lang_pred"), F.col("_found.score")
    )
