"""What the classifiers learn from: whole texts, bounded rows, every language; and scores by plain loops."""

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import language, quality, toxicity
from millrace.llm.common import held_out
from millrace.llm.labels import in_tasks, sample

SCHEMA = "doc_id long, text string, lang string, _label string, _text string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, k, "x", "y") for i, t, k in rows], SCHEMA)


def slice_of(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(t) for t in raw])]


def test_sample_reads_whole_texts_and_bounds_rows_per_label(spark):
    rows = [(i, "x" * (50_000 + i), "big" if i % 10 else "rare") for i in range(200)] + [(300, None, "big"), (None, "t", "big"), (301, "a", None)]
    size = lambda text: F.length(text)
    taken = sample(frame(spark, rows), F.col("lang"), 1_000, size, per_label=12)
    labels = [label for label, _ in taken]
    assert labels.count("big") == 12 and 0 < labels.count("rare") <= 12
    assert all(n == 0 or n >= 50_000 for _, n in taken)
    assert taken == sample(frame(spark, rows).repartition(5), F.col("lang"), 1_000, size, per_label=12)
    assert len(sample(frame(spark, rows), F.col("lang"), 5, size)) == 5
    kept = frame(spark, rows).where(held_out(F.col("doc_id"))).count()
    assert len(sample(frame(spark, rows), F.col("lang"), 1_000, size)) == 201 - kept
    assert sample(frame(spark, []), F.col("lang"), 5, size) == []


def test_features_of_slices_equal_those_of_single_texts(spark):
    texts = ["", "One two, one TWO!", "é漢字 x", " \n", "word " * 3000 + "last", "a" * 5000]
    df = frame(spark, [(i, t, "l") for i, t in enumerate(texts)])
    import pyarrow as pa

    hashed = in_tasks(toxicity._distinct_buckets, pa.list_(pa.int32()), "array<int>", 1 << 10)
    for row in df.select("text", hashed(F.col("text").cast("binary")).alias("found")).collect():
        data, bounds = slice_of([row["text"]])
        rows, buckets = toxicity.word_buckets(data, bounds)
        assert row["found"] == sorted(set(buckets.tolist()))
    drawn = language._drawn_words(*slice_of(texts))
    assert drawn[0] == b"" and drawn[1] == texts[1].encode() and drawn[3] == b""
    assert len(drawn[4]) <= language.WORD_BYTES and len(drawn[5]) > 1000


def test_trees_equal_a_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < 0)).astype(float)
    trees = quality.train(x, y)
    for row in x[:40]:
        total = trees.start
        for feature, limit, value in zip(trees.features, trees.limits, trees.values):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > limit[node] else 1)
            total += value[node - len(feature)]
        assert np.isclose(total, trees.raw(row[None, :])[0])
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.95


def test_network_equals_a_loop_over_bytes():
    network = language.Network.fresh(["a", "b", "c"], np.random.default_rng(2))
    texts = ["one two", "äöü", "x", "a-long-word-that-is-cut twice twice"]
    data, bounds = slice_of(texts)
    got = language.document_probabilities(network, data, bounds)
    h = language._HIDDEN
    sigmoid = lambda z: 1 / (1 + np.exp(-z))

    def states(word, direction):
        state, out = np.zeros(h), []
        for byte in word if direction == 0 else reversed(word):
            given, kept = network.byte[direction, byte], state @ network.state[direction][:, : 2 * h]
            update, reset = sigmoid(given[:h] + kept[:h]), sigmoid(given[h : 2 * h] + kept[h:])
            fresh = np.tanh(given[2 * h :] + reset * (state @ network.state[direction][:, 2 * h :]))
            state = update * state + (1 - update) * fresh
            out.append(state)
        return out if direction == 0 else out[::-1]

    for row, text in enumerate(texts):
        total, n = np.zeros(3), 0
        for word in text.encode().split():
            for at in range(0, len(word), language._LONGEST):
                part = word[at : at + language._LONGEST]
                for one, two in zip(states(part, 0), states(part, 1)):
                    logits = np.r_[one, two, 1] @ network.out
                    total += np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
                    n += 1
        assert np.allclose(got[row], total / n, atol=1e-4)
