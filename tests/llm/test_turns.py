"""Conversation repair against a search by uniform cost, whole and in chunks."""

import hashlib
import heapq
import random
import time
import zlib

from millrace.llm.turns import damage, repair_conversations

SCHEMA = "conv_id long, turn long, role string, text string, _c int, gone_ string, cost double"
BLANK = " \t\n\x0b\x0c\r"


def repaired_by_queue(turns):
    """(cost, audit, text) of (role, text, has to go, is short): the queue gives the least cost, then audit."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if i == len(turns) and last in ("", "a"):
            return cost, audit, "\n".join(lines)
        if (i, last) in seen:
            continue
        seen.add((i, last))
        target = "a" if last == "u" else "u"
        name = {"a": "assistant", "u": "user"}[target]
        heapq.heappush(heap, (cost + 2, audit + "I", i, target, (*lines, f"{name}:")))
        if i < len(turns):
            role, text, gone, short = turns[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, lines))
            if not gone:
                heapq.heappush(heap, (cost + 2 + short, audit + "R", i + 1, target, (*lines, f"{name}:{text}")))
                if role[:1] == target or (last == "" and role[:1] == "s"):
                    heapq.heappush(heap, (cost + short, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))


def expected(rows, damaged):
    """Results by conv_id of rows (conv_id, turn, role, text)."""
    groups = {}
    for conv, turn, role, text in rows:
        mine = groups.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 19
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(kind, text)
        role = "user" if kind == 4 else role
        mine += [(turn is not None, turn or 0, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    found = []
    for conv, mine in groups.items():
        mine.sort()
        seen, turns, names = set(), [], []
        for _, _, role, text in mine:
            body = text.strip(BLANK)
            names.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
            turns.append((role, text, names[-1] in ("blank", "duplicate"), names[-1] == "truncated"))
        cost, audit, left = repaired_by_queue(turns)
        numbers = [t for some, t, _, _ in mine if some]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        found.append((conv, gaps, *(names.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                      hashlib.sha256(left.encode()).hexdigest()))
    return found


def cases(most=9):
    rng = random.Random(8)
    roles = ["user", "assistant", "system", "user", "assistant", "u", "s", "tool", "", None]
    texts = ["Yes.", "No!", "why", "so ", "Really? \n", "", " \t", None, "ünï.", "…", "One. Two"]
    rows = []
    for conv in range(150):
        turns = [(conv, t, rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"{rng.random()}{rng.choice('.x')}") for t in range(rng.randint(1, most))]
        rows += [r for r in turns if rng.random() < 0.9] or turns[:1]
    rows += [(200, None, "user", "a."), (200, None, "assistant", "b."), (200, 5, "user", "a."), (None, 1, "user", "null"), (None, None, None, None)]
    rows += [(201, 3, "user", "Same."), (201, 3, "user", "Same."), (202, 9, "assistant", "x" * 300_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 4, "x", 0.5) for r in rows], SCHEMA)


def compare(found, wanted):
    key = lambda r: repr(r)
    assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)


def test_whole_conversations_equal_the_queue(spark):
    rows = cases()
    compare(repair_conversations(damage(frame(spark, rows))).collect(), expected(rows, True))


def test_chunks_give_the_same(spark):
    rows = cases(40)
    for chunk in (1, 2, 7):
        compare(repair_conversations(frame(spark, rows), chunk_rows=chunk).collect(), expected(rows, False))


def test_long_conversation_empty_table_and_dropped_turns(spark):
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "tool"]), f"{t % 700} {rng.choice('.. x')}") for t in range(6000)]
    started = time.time()
    compare(repair_conversations(damage(frame(spark, rows))).collect(), expected(rows, True))
    assert time.time() - started < 60
    assert repair_conversations(damage(frame(spark, []))).count() == 0
    gone = next((c, 1, "user", "Hi.") for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    compare(repair_conversations(damage(frame(spark, [gone]))).collect(), [(gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())])
