"""The training-data operators against brute force on small tables with the awkward cases."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import decontamination, language, lines, pieces, quality, similar, simhash, substrings, suffixes, topk, toxicity
from millrace.llm.common import held_out
from millrace.llm.components import components
from millrace.llm.queries import QUERIES, SQL
from tests import oracle

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _text string, score double, ids int"
LABELS = "doc_id long, quality int, toxic int"


def frame(spark, rows):
    """Documents with extra columns whose names clash with what operators use."""
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", "y", 0.5, 3) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = say(90)
    rows = [(i, say(rng.randint(0, 160)) + rng.choice(["", "\n"]) + say(30)) for i in range(1, 30)]
    rows += [(i, say(20) + "\n" + shared + "\n" + say(15)) for i in range(30, 40)]
    rows += [(i, shared) for i in range(40, 46)]
    rows += [(50, None), (51, ""), (52, " \n\t "), (53, "é" * 900), (54, "ab" * 700), (55, rows[3][1]), (55, rows[3][1])]
    rows += [(None, shared), (None, None), (56, say(9000) + " " + shared)]
    return rows


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    problem, rows = oracle.compare(spark, oracle.connect(SMALL), QUERIES[name], SQL[name], SMALL)
    assert problem == "" and rows > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_have_a_method_row(name):
    assert re.fullmatch(r"op\d+_\w+", name)


def test_spans_equal_brute_force(spark, corpus):
    first = {}
    words = [(i, (t or "").split()) for i, t in corpus]
    for i, w in words:
        if i is not None:
            for p in range(len(w) - 12):
                key = tuple(w[p : p + 13])
                first[key] = min(first.get(key, i), i)
    want = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - 12):
            if i is not None and first[tuple(w[p : p + 13])] < i:
                gone.update(range(p, p + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((str(i), len(w), len(gone), kept))
    got = [(str(r[0]), r[1], r[2], bytes(r[3]).decode()) for r in substrings.remove_repeated_spans(frame(spark, corpus)).collect()]
    assert sorted(got) == sorted(want)
    assert any(n for _, _, n, _ in got)


def test_bytes_equal_brute_force(spark, corpus):
    size = 64
    seen = {}
    raw = [(i, (t or "").encode()) for i, t in corpus if len(t or "") < 5000]
    for _, b in raw:
        for p in range(len(b) - size + 1):
            seen[b[p : p + size]] = seen.get(b[p : p + size], 0) + 1
    want = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - size + 1):
            if seen[b[p : p + size]] > 1:
                gone[p : p + size] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want.append((str(i), len(b), int(gone.sum()), spans, kept))
    few = frame(spark, [(i, t) for i, t in corpus if len(t or "") < 5000])
    got = [(str(r[0]), r[1], r[2], r[3], bytes(r[4])) for r in suffixes.remove_repeated_bytes(few, size=size).collect()]
    assert sorted(got) == sorted(want)


def test_simhash_equals_brute_force(spark, corpus):
    def mark(text):
        w = [x.lower() for x in (text or "").encode().split()]
        if not w:
            return 0
        hashes = [xxhash.xxh64_intdigest(b" ".join(w[p : p + 4]), 42) for p in range(max(1, len(w) - 3))]
        return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))

    prints = [mark(t) for _, t in corpus]
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(corpus):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    want = [(str(i), f"{prints[k]:016x}", str(least.get(find(k)))) for k, (i, _) in enumerate(corpus)]
    got = [(str(r[0]), r[1], str(r[2])) for r in simhash.near_duplicates(frame(spark, corpus), tile_rows=7).collect()]
    assert sorted(got) == sorted(want)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (3, 2)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_top_products_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = {i: (rng.normal(size=6) * (1 + i % 4)).round(2).tolist() for i in range(0, 300)}
    vectors[7] = vectors[8] = vectors[100]
    rows = [(i, v, 1.0) for i, v in vectors.items()]
    rows += [(500, None, 0.0), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0.0), (502, [float("nan")] * 6, 0.0), (503, [float("inf")] * 6, 0.0)]
    rows += [(None, [1.0] * 6, 0.0), (100, vectors[100], 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double")
    whole = {i: np.floor(256 * np.array(v)).astype(int) for i, v in vectors.items()}
    want = []
    for q in range(0, 300, 50):
        scored = sorted(((-int(whole[q] @ v), i) for i, v in whole.items() if i != q))[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    got = [tuple(r) for r in topk.top_inner_products(df, bucket_rows=40).collect()]
    assert sorted(got) == sorted(want)
    assert topk.top_inner_products(df.limit(0)).count() == 0


def test_lines_keep_the_first_copy(spark):
    long = "a long line that holds more than forty characters"
    rows = [(1, f"{long}\nx\ny"), (2, f"{long}\nz"), (3, "one\ntwo\nthree, which holds more than forty characters\nend"), (None, None), (9, "")]
    rows += [(4, "zero\none\ntwo\nthree, which holds more than forty characters\nlast"), (5, long), (5, long)]
    df = frame(spark, rows)
    done = lines.remove_repeated_lines(df, report="found")
    got = sorted((str(r["doc_id"]), r["text"], r["found"]["n_removed"]) for r in done.collect())
    assert got == sorted(
        [("1", f"{long}\nx\ny", 0), ("2", "z", 1), ("3", rows[2][1], 0), ("None", None, 0), ("9", "", 0)]
        + [("4", "zero\nlast", 3), ("5", "", 1), ("5", "", 1)]
    )
    assert done.columns[:-1] == df.columns
    assert lines.remove_repeated_lines(df.limit(0)).count() == 0


def test_native_operators_use_no_python(spark, capsys):
    df = frame(spark, [(1, "a\nb")])
    lines.remove_repeated_lines(df).explain()
    decontamination.remove_contaminated(df, spark.createDataFrame([(1, "q")], "item_id long, text string")).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_templates_catch_new_values_and_check_slots(spark):
    item = "If the farmer meets Anna Smith at the market and buys 12 kg of apples, then Anna Smith pays 30 dollars for the 12 boxes."
    other = item.replace("Anna Smith", "Bob").replace("12", "7").replace("30", "45")
    torn = other.replace("Bob pays", "Carl pays")
    text = "Some words that stand before it here. {} And words after that are of no interest."
    rows = [(1, text.format(item)), (2, text.format(other)), (3, text.format(torn)), (4, "no question in here " * 20)]
    rows += [(5, None), (6, ""), (None, item), (7, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16"), (2, text.format(other))]
    bench = spark.createDataFrame([(1, item, 0), (2, None, 0), (3, "too short", 0), (None, "x", 0)], "item_id long, text string, _id int")
    found = {(r["_id"], r["item_id"]) for r in decontamination.contaminated(frame(spark, rows), bench).collect()}
    assert found == {(1, 1), (2, 1), (None, 1)}
    left = decontamination.remove_contaminated(frame(spark, rows), bench)
    assert sorted(str(r[0]) for r in left.select("doc_id").collect()) == ["3", "4", "5", "6", "7"]
    assert decontamination.contaminated(frame(spark, rows), bench.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.exists(pieces.MODEL_PATH), reason="no tokenizer files")
def test_pieces_equal_the_library_and_round_trip(spark, corpus):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    rng = random.Random(2)
    odd = ["".join(rng.choice("abcthe  éü漢字😀\n\t.▁0189 ") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    rows = list(enumerate(odd + [" " * n for n in range(20)] + [t for _, t in corpus]))
    df = frame(spark, rows).withColumn("found", pieces.encode(spark, F.col("text")))
    df = df.withColumn("back", pieces.decode(spark, F.col("found")))
    for r in df.select("text", "found", "back").collect():
        assert r["found"] == (None if r["text"] is None else library.encode(r["text"]))
        assert r["back"] == (None if r["text"] is None else r["text"].replace(pieces.SPACE, " "))


def test_unigram_models_take_the_heaviest_path():
    text = lambda n, b: bytes([n << 3 | 2, len(b)]) + b
    piece = lambda t, s, k=1: text(1, text(1, t.encode()) + b"\x15" + np.float32(s).tobytes() + bytes([3 << 3, k]))
    model = piece("<unk>", 0, 2) + piece("▁", -3) + piece("▁a", -2) + piece("ab", -1) + piece("b", -4) + piece("▁ab", -6)
    t = pieces.Transducer(model + text(2, b"\x18\x01") + text(3, b"\x18\x01\x20\x00"))
    assert [t.texts[i] for i in np.frombuffer(t.encode("ab"), np.int32)] == ["▁", "ab"]


def test_classifiers_learn_and_keep_rows(spark):
    rng = random.Random(3)
    say = lambda n, v: " ".join(rng.choice(v) for _ in range(n))
    mild, bad = [f"word{i}" for i in range(200)], ["vile", "awful", "nasty"]
    rows, labels = [], []
    for i in range(600):
        toxic, poor = i % 7 == 0, i % 3 == 0
        t = say(40, mild) + (" " + say(3, bad) if toxic else "")
        rows.append((i, t.upper() + "!!" * 9 if poor else t))
        labels.append((i, int(not poor), int(toxic)))
    df = frame(spark, rows + [(900, None), (901, ""), (None, "x"), (3, rows[3][1]), (902, "y" * 300_000)])
    marks = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None), (7777, 1, 1)], LABELS)
    for run, column in ((quality.quality, 1), (toxicity.toxicity, 2)):
        got = run(df, marks).collect()
        assert len(got) == 605 and all(0 <= r["score"] <= 1 for r in got)
        held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600]
        assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
        right = sum(r["predicted"] == labels[r["doc_id"]][column] for r in held)
        assert right >= 0.93 * len(held)
        assert run(df.limit(0), marks).count() == 0
        assert run(df, marks.limit(0)).count() == 605


def test_language_and_its_gradients(spark):
    rng = random.Random(5)
    pools = {"xx": ["kato", "mila", "toka", "lami"], "yy": ["zwerk", "schlap", "krumm", "nacht"]}
    rows = [(i, " ".join(rng.choice(pools[k]) for _ in range(20)), k) for i in range(300) for k in [list(pools)[i % 2]]]
    rows += [(900, None, "xx"), (901, "", "xx"), (902, "123 !!", "yy"), (None, "kato mila", None), (903, "漢字", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language.languages(df).collect()}
    assert [got[k]["lang_pred"] for k in (900, 901, 902)] == ["und"] * 3 and got[None]["lang_pred"] == "xx"
    assert got[903]["lang_pred"] in pools
    assert all(got[i]["lang_pred"] == k for i, _, k in rows[:300])
    assert {r["lang_pred"] for r in language.languages(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    net = language.Network.fresh(["a", "b", "c"], np.random.default_rng(0))
    net.byte, net.state, net.out = (w.astype(np.float64) for w in (net.byte, net.state, net.out))
    words, sizes, target = np.array([[1, 2, 3], [4, 5, 0]], np.uint8), np.array([3, 2]), np.array([0, 2])

    def loss():
        p = net.label(net.read(words, sizes).astype(np.float64))
        return -sum(np.log(p[n, t, target[n]]) for n in range(2) for t in range(sizes[n])) / sizes.sum()

    for w, g in zip((net.byte, net.state, net.out), net.gradients(words, sizes, target)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        w[at] += 1e-3
        up = loss()
        w[at] -= 2e-3
        down = loss()
        w[at] += 1e-3
        assert abs((up - down) / 2e-3 - g[at]) < 2e-3 + 0.02 * abs(g[at])


def test_held_out_is_the_stated_remainder(spark):
    got = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
def test_pipeline_on_planted_cases(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    question = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = "Quiet harbour lights drew slow circles over dark water while " + " ".join(f"plain{i}" for i in range(40))
    rows = [(-1, clean), (-3, clean), (-2, clean + " " + question), (-5, None), (-4, "")]
    extra = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], docs.schema)
    last = docs.unionByName(extra)
    for name, stage in pipeline.STAGES[:-1]:
        columns, last = last.columns, stage(spark, last, SMALL).cache()
        assert last.columns == columns, name
    done = pipeline.STAGES[-1][1](spark, last, SMALL).where("doc_id < 0").collect()
    assert {r["doc_id"] for r in done} == {-3, -5}
    kept = {r["doc_id"]: r for r in done}
    assert kept[-3]["decoded"] == clean and kept[-5]["ids"] is None
    assert hashlib.sha256(kept[-3]["decoded"].encode()).hexdigest() == hashlib.sha256(clean.encode()).hexdigest()
    none = docs.limit(0)
    for _, stage in pipeline.STAGES:
        none = stage(spark, none, SMALL)
    assert none.count() == 0


def test_pieces_round_trip_equals_encode_then_decode(spark):
    from millrace.llm.pieces import compiled, decode, encode, read_model, round_trip

    texts = ["", None, "Two words", "  spaced  out ", "naïve café 你好 🙂", "x" * 3000, "word " * 5000, "a\0b\nc", "Two words"]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n INT, t STRING").coalesce(1)
    both = {r["n"]: r["b"] for r in df.select("n", round_trip(spark, F.col("t")).alias("b")).collect()}
    ids = df.select("n", encode(spark, F.col("t")).alias("ids"))
    apart = {r["n"]: r for r in ids.select("n", "ids", decode(spark, F.col("ids")).alias("decoded")).collect()}
    model = compiled(read_model())
    for n, text in enumerate(texts):
        assert both[n]["ids"] == apart[n]["ids"] and both[n]["decoded"] == apart[n]["decoded"] == text
        if text is not None:
            assert model.decode(both[n]["ids"]) == text
    odd = spark.createDataFrame([([3, None, -1, 10**6],), ([],), (None,)], "ids ARRAY<INT>").coalesce(1)
    got = [r[0] for r in odd.select(decode(spark, F.col("ids"))).collect()]
    assert got == [model.decode([3]), "", None]


def test_near_copies_go_from_the_pipeline_by_similarity(spark, monkeypatch):
    import corpus_pipeline as pipeline

    rng = random.Random(8)
    say = lambda n: [f"v{rng.randrange(4000)}" for _ in range(n)]
    texts = {0: None, 1: " "}
    for base in range(10, 510, 10):
        words = say(rng.randint(30, 300))
        texts[base] = " ".join(words)
        for k in range(1, 4):  # edited copies, on both sides of the similarity
            copy = list(words)
            for _ in range(max(1, len(words) * k // 60)):
                copy[rng.randrange(len(copy))] = "edited"
            texts[base + k] = " ".join(copy)
    for k in range(600, 640):  # one large group
        copy = texts[10].split()
        copy[rng.randrange(len(copy))] = f"x{k}"
        texts[k] = " ".join(copy)
    sets = {}
    for i, t in texts.items():
        w = (t or "").split()
        sets[i] = frozenset(tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4)))
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    edited = 0
    for a in texts:
        for b in texts:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                edited += sets[a] != sets[b]
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = sorted(i for i in texts if find(i) == i)
    df = frame(spark, list(texts.items()))
    got = pipeline.drop_near_duplicates(spark, df, SMALL)
    assert got.columns == df.columns
    assert sorted(r[0] for r in got.select("doc_id").collect()) == want
    assert edited > 60 and 60 < len(want) < 150
    monkeypatch.setattr(similar, "_DENSE", 0)  # all tile pairs are read again
    groups = similar.similar_groups(df, tile_rows=40).collect()
    assert {r["doc_id"]: r["component_id"] for r in groups} == {i: find(i) for i in texts}


def test_whole_runs_of_lines_go_from_the_pipeline(spark):
    import corpus_pipeline as pipeline

    rng = random.Random(9)
    pool = ["", "x", "short", "eighteen letters..", "a line of some twenty", "one line that alone holds more than forty characters"]
    three = ["first of the three", "next one of three.", "third of the three"]
    rows = [(1, "\n".join(["own", *three, "tail"])), (2, "\n".join(["other", *three, "end"]))]
    rows += [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14)))) for i in range(3, 90)]
    rows += [(90, None), (91, ""), (92, rows[5][1])]
    seen, want = {}, {}
    for i, t in rows:
        if t is None:
            want[i] = None
            continue
        got = t.split("\n")
        gone = set()
        for s in range(len(got)):
            for e in range(s + 1, len(got) + 1):
                run = tuple(got[s:e])
                if sum(len(x) + 1 for x in run) >= 40:
                    if seen.setdefault(run, (i, s)) != (i, s):
                        gone.update(range(s, e))
        want[i] = "\n".join(x for k, x in enumerate(got) if k not in gone)
    done = pipeline.drop_repeated_lines(spark, frame(spark, rows), SMALL)
    assert {r["doc_id"]: r["text"] for r in done.collect()} == want
    assert want[2] == "other\nend"


def test_top_products_meet_bounded_blocks_of_queries(spark, monkeypatch):
    search = topk._search

    def watched(k):
        inner = search(k)

        def run(left, right):
            assert len(right) <= 60 and len(left) <= 150, (len(left), len(right))
            return inner(left, right)

        return run

    monkeypatch.setattr(topk, "_search", watched)
    rng = np.random.default_rng(2)
    units = rng.normal(size=(400, 8))
    units /= np.linalg.norm(units, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(units)], "vec_id long, embedding array<double>")
    whole = np.floor(256 * units).astype(int)
    scores = whole @ whole.T
    want = []
    for q in range(400):
        best = sorted((-int(scores[q, i]), i) for i in range(400) if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    found = topk.top_inner_products(df, is_query=F.lit(True), bucket_rows=90, query_rows=30).collect()
    assert sorted(tuple(r) for r in found) == sorted(want)


def test_templates_keep_equal_windows_and_odd_punctuation(spark):
    words = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(50))
    item = f"we count 5 of them and {words} then again 5 at last"
    quoted = "they all went by train to Paris\u201d and saw Rome\u2014 then came home by bus to Bern again and slept"
    rows = [(1, item.replace("again 5", "again 6")), (2, "so we met Anna\u201d once and left. " + quoted), (3, words[:40])]
    bench = spark.createDataFrame([(1, item), (2, quoted)], "item_id long, text string")
    found = {(r["_id"], r["item_id"]) for r in decontamination.contaminated(frame(spark, rows), bench).collect()}
    assert found == {(1, 1), (2, 2)}


def test_templates_of_long_runs_of_names_and_numbers(spark):
    """A run of any length is one placeholder, and takes no stack for each of its words (the JVM ended at some 1,200)."""
    item = "If the farmer meets Anna Smith at the market and buys 12 kg of apples, then Anna Smith pays 30 dollars for the 12 boxes."
    names, numbers = (" ".join(["Wörd"] * 30_000), ":".join(["12"] * 30_000))
    rows = [(1, f"we saw {names} and {item}"), (2, f"we count {numbers} and {item}"), (3, f"we saw {names} and {numbers} there")]
    df = frame(spark, rows)
    parts = [decontamination.tokens(F.col("text")), *decontamination.slot_values(F.col("text"))]
    whole, named, numbered = (len(part) for part in frame(spark, [(1, item)]).select(*parts).first())
    sizes = df.select("doc_id", *[F.size(part) for part in parts]).collect()
    # Inside a sentence "If" is one more name.
    assert sorted(map(tuple, sizes)) == [(1, whole + 4, named + 2, numbered), (2, whole + 4, named + 1, numbered + 1), (3, 6, 1, 1)]
    found = decontamination.contaminated(df, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert {(r["_id"], r["item_id"]) for r in found.collect()} == {(1, 7), (2, 7)}
