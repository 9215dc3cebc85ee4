"""Fill-in-middle against a loop over characters, and exact restoring."""

import hashlib
import random

import numpy as np

from millrace.llm import infill

SCHEMA = "doc_id long, text string, n string, form string, _row int, low int"


def expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    x, y, z = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{z}<P>{x}<M>{y}"
    return n, "psm", a, b - a, f"<P>{x}<S>{z}<M>{y}"


def cases():
    rng = random.Random(3)
    letters = ["a", "é", "漢", "🙂", "<", "P", ">", "\n", "é", "<P", "S>"]
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 9)))) for i in range(400)]
    rows += [(400, None), (401, ""), (None, "null id"), (None, None), (402, "x<M>y"), (402, "x<M>y"), (403, "漢é<" * 900_000)]
    return rows + [(k, text) for k in (500, 501, 501) for text in ("same text", "same text")]


def test_outputs_equal_a_loop_and_texts_come_back(spark):
    docs = spark.createDataFrame([(i, t, "clash", "clash", 7, 8) for i, t in cases()], SCHEMA)
    made = infill.fill_in_middle(docs)
    assert made.columns == ["doc_id", "text", "n", "form", "_row", "low", "prefix_chars", "middle_chars", "output"]
    found = made.withColumn("back", infill.restored()).collect()
    key = lambda r: repr(r)
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, bytes(r.output).decode()) for r in found]
    assert sorted(got, key=key) == sorted([(i, *expected(i, t)) for i, t in cases()], key=key)
    assert all(bytes(r.back).decode() == (r.text or "") for r in found)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_empty_table_and_blocks(spark, monkeypatch):
    empty = spark.createDataFrame([], SCHEMA)
    assert infill.fill_in_middle(empty).withColumn("back", infill.restored()).count() == 0
    monkeypatch.setattr(infill, "_BLOCK", 5)
    texts = ["abcdefghijklmnop", "", "é漢🙂" * 4, "x", ""]
    raw = [t.encode() for t in texts]
    bounds = np.r_[0, np.cumsum([len(t) for t in raw])].astype(np.int64)
    low, high, form = np.array([3, 0, 2, 0, 0]), np.array([9, 0, 7, 1, 0]), np.array([1, 0, 2, 2, 0])
    made, out = infill.scatter(np.frombuffer(b"".join(raw), np.uint8), bounds, low, high, form)
    pieces = [made[out[k] : out[k + 1]].tobytes().decode() for k in range(len(texts))]
    assert pieces == ["<P>abc<S>jklmnop<M>defghi", "", "<S>" + ("é漢🙂" * 4)[7:] + "<P>é漢<M>🙂é漢🙂é", "<S><P><M>x", ""]
    back, ends = infill.gather(made, out, form)
    assert back.tobytes() == b"".join(raw) and ends.tolist() == bounds.tolist()
