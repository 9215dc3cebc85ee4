"""The second pass of the near-duplicate groups: few links, whole results, bounded tables of the pieces."""

import os
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from millrace.llm import pieces, similar


def tile(sets):
    hashes = [np.unique(np.array(s, dtype=np.uint64)) for s in sets]
    prints = np.array([similar.fingerprint(h) for h in hashes], dtype=np.uint64)
    sizes = np.array([len(h) for h in hashes])
    return np.arange(len(sets)), sizes, prints, [h.view(np.int64) for h in hashes]


def near_copies(rng, n, share, words=300):
    base = [rng.getrandbits(63) for _ in range(words)]
    return [[h if rng.random() < share else rng.getrandbits(63) for h in base] for _ in range(n)]


def test_a_large_group_under_the_threshold_gives_nothing():
    """4,000 copies of one text that share 60 % with each other: millions of near pairs, none similar."""
    nodes, sizes, prints, sets = tile(near_copies(random.Random(1), 4000, 0.75**0.5))
    found = similar.joining_links(nodes, sizes, prints, nodes.copy(), np.ones(len(nodes), dtype=bool), sets, 0.8)
    assert found == []


def test_links_join_what_brute_force_joins(monkeypatch):
    rng = random.Random(2)
    sets = near_copies(rng, 60, 0.93) + near_copies(rng, 60, 0.86) + near_copies(rng, 40, 0.9, 7) + near_copies(rng, 40, 0.95, 12)
    nodes, sizes, prints, sets = tile(sets)
    monkeypatch.setattr(similar, "RADIUS", 256)
    for left in (np.ones(len(nodes), dtype=bool), np.arange(len(nodes)) % 2 == 0):
        parent = list(range(len(nodes)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a in range(len(nodes)):
            for b in range(len(nodes)):
                common = len(np.intersect1d(sets[a], sets[b]))
                if left[a] and (left.all() or not left[b]) and common / (sizes[a] + sizes[b] - common) >= 0.8:
                    parent[root(a)] = root(b)
        wanted = [root(a) for a in range(len(nodes))]
        found = similar.joining_links(nodes, sizes, prints, nodes.copy(), left, sets, 0.8)
        assert len(found) == len(nodes) - len(set(wanted))
        parent = list(range(len(nodes)))
        for a, b in found:
            parent[root(a)] = root(b)
        got = [root(a) for a in range(len(nodes))]
        assert [got.index(g) for g in got] == [wanted.index(w) for w in wanted]


def test_radius_finds_similar_texts():
    """Of pairs just over the threshold, short texts included, nearly all are within both radii."""
    rng = random.Random(3)
    missed = total = 0
    for words in (5, 8, 12, 20, 60, 300):
        for _ in range(300):
            a = {rng.getrandbits(64) for _ in range(words)}
            kept = set(list(a)[: -(-len(a) * 9 // 10)])
            b = kept | {rng.getrandbits(64) for _ in range(len(a) - len(kept))}
            if len(a & b) / len(a | b) < 0.8 or a == b:
                continue
            x, y = (similar.fingerprint(np.array(sorted(s), dtype=np.uint64)) for s in (a, b))
            bits = np.bitwise_count(x ^ y)
            total += 1
            missed += int(bits[0] > similar.FIRST_RADIUS or bits.sum() > similar.RADIUS)
    assert total > 500 and missed / total < 0.1


def test_large_groups_through_spark(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for group, (n, edits) in enumerate([(150, 1), (150, 14)]):
        base = [f"{group}{rng.choice(words)}" for _ in range(120)]
        for k in range(n):
            text = list(base)
            for at in rng.sample(range(120), edits):
                text[at] = f"edit{rng.random()}"
            rows.append((1000 * group + k, " ".join(text)))
    found = {r.doc_id: r.component_id for r in similar.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), tile_rows=40).collect()}
    sets = {i: set(similar.shingles(t.encode()).tolist()) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert found == {i: root(i) for i in sets}


def test_tables_of_solved_words_stay_small(monkeypatch):
    monkeypatch.setattr(pieces, "_WORDS_KEPT", 50)
    monkeypatch.setattr(pieces, "_PAIRS_KEPT", 40)
    transducer = pieces.Transducer(pieces.read_model())
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdeéü") for _ in range(rng.randint(1, 8))) for _ in range(12)) for _ in range(60)]
    whole = pieces.Transducer(pieces.read_model())
    for text in texts:
        assert transducer.encode_all([text]) == [whole.encode(text)]
        assert len(transducer.solved) <= 50 and len(transducer.codes) <= 40 and len(transducer.pairs) <= 10


@pytest.mark.skipif(not os.path.exists(pieces.MODEL_PATH), reason="no tokenizer files")
def test_pieces_solve_many_new_words_in_bounded_memory():
    rng = random.Random(8)
    words = list({pieces.SPACE + "".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(3, 9))) for _ in range(60_000)})
    words += [pieces.SPACE + "the" * 13, pieces.SPACE + "漢字"]
    transducer = pieces.Transducer(pieces.read_model())
    transducer._fits = lambda code: True  # its tables are bounded by themselves
    tracemalloc.start()
    transducer.solve_all(words)
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak - kept < 20e6

    sample = rng.sample(words, 300) + words[-2:]
    transducer = pieces.Transducer(pieces.read_model())
    transducer.solve_all(sample)
    alone = pieces.Transducer(pieces.read_model())
    assert [transducer.solved.get(w) or transducer.solve(w) for w in sample] == [alone.solve(w) for w in sample]


@pytest.mark.skipif(not os.path.exists(pieces.MODEL_PATH), reason="no tokenizer files")
def test_pieces_of_a_batch_are_sent_on_in_groups(spark, monkeypatch):
    texts = [None, "", *(f"text {i} " * 40 for i in range(50)), "x" * 3000, None]
    seen = []
    done = pieces.in_groups(iter([pa.array(texts), pa.array([], pa.string())]), pc.binary_length, 1000, lambda p: seen.append(p) or p)
    first = next(done)
    assert len(seen) == 1 and first.equals(seen[0])
    parts = [first, *done]
    assert pa.concat_arrays(parts).to_pylist() == texts
    assert all(len(p) == 1 or sum(len(t or "") for t in p.to_pylist()) <= 1000 for p in parts)

    monkeypatch.setattr(pieces, "_GROUP_BYTES", 1000)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    both = df.select("i", "text", pieces.round_trip(spark, F.col("text")).alias("b"), pieces.encode(spark, F.col("text")).alias("e"))
    rows = both.withColumn("d", pieces.decode(spark, F.col("e"))).orderBy("i").collect()
    assert [r["b"]["ids"] for r in rows] == [r["e"] for r in rows]
    assert [r["d"] for r in rows] == [r["b"]["decoded"] for r in rows] == texts


@pytest.mark.skipif(not os.path.exists(pieces.MODEL_PATH), reason="no tokenizer files")
def test_pieces_of_a_task_leave_little_behind():
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choices("abcdefghilmnoprstué☃", k=rng.randint(3, 9))) for _ in range(200)) for _ in range(200)]
    batches = [pa.array(texts[:120]), pa.array([None, "", *texts[120:]])]
    alone = pieces.Transducer(pieces.read_model())
    right = [None if t is None else np.frombuffer(alone.encode(t), np.int32).tolist() for b in batches for t in b.to_pylist()]
    transducer = pieces.Transducer(pieces.read_model())
    tracemalloc.start()
    done = pieces.in_task(transducer, iter(batches), pc.binary_length, 1 << 16, transducer.encode_array)
    found = [ids for part in done for ids in part.to_pylist()]
    assert found == right
    del found, done, right, alone
    kept, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    # What stays is the building of pieces, bounded by the model; 38,000 words of such a task took 30 MB more.
    assert not transducer.solved and not transducer.pairs and kept < 4e6


@pytest.mark.skipif(not os.path.exists(pieces.MODEL_PATH), reason="no tokenizer files")
def test_pairs_that_share_a_place_are_told_apart(monkeypatch):
    monkeypatch.setattr(pieces, "_PAIRS_KEPT", 2)
    transducer = pieces.Transducer(pieces.read_model())
    rng = random.Random(10)
    ids = list(transducer.ids.values())
    codes = np.unique([((rng.choice(ids) + 1 if rng.random() < 0.9 else 0) << 32) | rng.choice(ids) for _ in range(2000)])
    for _ in range(2):
        for part in np.array_split(codes, 7):
            fits = [
                transducer.history(transducer.texts[c & 0xFFFFFFFF]) is not None
                if c >> 32 == 0
                else transducer.accepted(transducer.texts[(c >> 32) - 1], transducer.texts[c & 0xFFFFFFFF])
                for c in part.tolist()
            ]
            assert transducer._fit(part).tolist() == fits
