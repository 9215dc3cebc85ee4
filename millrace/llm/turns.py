"""Conversation structure repair by iterative-deepening A*.

A conversation is a sequence of turns; a repaired one reads `(s?(ua)+)?` by the first letters of its roles.
Edits keep, rerole, delete and insert turns at fixed costs. The cheapest edits are found by depth-first
search in ASCII order of the edits' letters under a cost bound, which grows to the least cost that it
cut off, until a path is accepted. A lower bound of the cost to go guides the search: turns that have
to go, turns cut short, and disjoint neighbours whose roles clash, each of which needs an edit. States that
failed are kept in a table with the cost they need at least, so that no later visit repeats them. As the order
is ASCII and the bound is the least cost, the first path accepted is the ASCII-least of the cheapest.

Conversations of any length are spread over tasks. Turns are dealt by ranges of (conversation, turn), and
each task searches the conversations it holds whole. One that crosses a task border, or has more than a chunk
of turns, is cut into chunks. A chunk is searched for each pair of grammar states at its ends; equal
costs never have one audit as the beginning of another (what follows would be insertions, which
cost), so the least audit of the whole is put together from chunks: a small table of costs and
ranks a chunk decides the states at the borders, and each chunk then applies its own edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import cut

CHUNK_ROWS = 1024
CHUNK_BYTES = 1 << 20
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
# White space, and what ends a sentence.
_BLANK = " \t\n\x0b\x0c\r"
_ENDS = ".!?"
_INFINITY = float("inf")

# States of the grammar, by what stands last: nothing, a system turn, a user turn, an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_CLASS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_OTHER = EMPTY
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_FOLLOWS = {EMPTY: {SYSTEM, USER}, SYSTEM: {USER}, USER: {ASSISTANT}, ASSISTANT: {USER}}
_NEXT = (USER, USER, ASSISTANT, USER)  # the one turn that may be inserted, or made by a new role, in a state
_LEGAL = {"su", "ua", "au"}
ACCEPTED = 4  # a goal beside the four states: the end of a conversation
_REACHED = {s: {s, USER, ASSISTANT} | ({SYSTEM} if s == EMPTY else set()) - {EMPTY} for s in range(4)}
_PAIRS = [(s, e) for s in range(4) for e in range(5) if e == ACCEPTED or e in _REACHED[s]]

_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
RESULT = [*_COUNTS, "cost", "audit", "repaired_sha256"]
_KEY = ["_c", "_null"]
_PLACE = [*_KEY, "_pid", "_seq"]


def faults(role: str, text: str, seen: bool) -> tuple[int, bool, bool, str]:
    """Class of the role, whether the turn has to go, whether it is cut short, and the name of its fault."""
    body = text.strip(_BLANK)
    kind = _CLASS.get(role[:1], _OTHER)
    if not body:
        return kind, True, False, "blank"
    if seen:
        return kind, True, False, "duplicate"
    short = body[-1] not in _ENDS
    return kind, False, short, "truncated" if short else ""


class Search:
    """Cheapest edits of a sequence of turns, given as (class, has to go, is cut short)."""

    def __init__(self, turns: list[tuple[int, bool, bool]]):
        self.turns = turns
        n = len(turns)
        self.base = [0] * (n + 1)  # cost that the turns from here on need whatever their roles
        self.clashes = [0] * (n + 2)  # disjoint clashes among the turns from here on
        self.after = [n] * (n + 1)  # first turn from here on that may stay
        self.systems = [_INFINITY] * (n + 1)  # cost of the cheapest system turn to keep, from here on
        for i in range(n - 1, -1, -1):
            kind, gone, short = turns[i]
            self.base[i] = self.base[i + 1] + (DELETE if gone else CUT_SHORT * short)
            following = self.after[i + 1]
            self.after[i] = following if gone else i
            self.clashes[i] = self.clashes[i + 1]
            self.systems[i] = self.systems[i + 1]
            if gone:
                continue
            if kind == SYSTEM:
                self.systems[i] = min(self.systems[i], CUT_SHORT * short)
            if kind == _OTHER:
                self.clashes[i] = self.clashes[i + 1] + 1
            elif following < n and turns[following][0] not in _FOLLOWS[kind]:
                self.clashes[i] = max(self.clashes[i + 1], self.clashes[following + 1] + 1)

    def least(self, i: int, state: int, goal: int) -> float:
        """A cost that reaching the goal from here needs at least."""
        n = len(self.turns)
        if goal == EMPTY:
            return DELETE * (n - i) if state == EMPTY else _INFINITY
        if goal == SYSTEM:
            if state == EMPTY:
                return DELETE * (n - i - 1) + self.systems[i]
            return DELETE * (n - i) if state == SYSTEM else _INFINITY
        if i == n:
            if goal == ACCEPTED:
                return (0, 2 * INSERT, INSERT, 0)[state]
            return 0 if state == goal else _INFINITY
        first = self.after[i]
        clashes = self.clashes[i]
        if first < n and self.turns[first][0] not in _FOLLOWS[state]:
            clashes = max(clashes, self.clashes[first + 1] + 1)
        return self.base[i] + min(REROLE, INSERT) * clashes

    def moves(self, i: int, state: int, goal: int) -> Iterator[tuple[str, int, int, int]]:
        """Edits in ASCII order of their letters: letter, cost, next turn, next state."""
        if i == len(self.turns):
            if goal == ACCEPTED:  # else insertions stand before the next turn, in the next chunk
                yield "I", INSERT, i, _NEXT[state]
            return
        kind, gone, short = self.turns[i]
        yield "D", DELETE, i + 1, state
        yield "I", INSERT, i, _NEXT[state]
        if not gone:
            if kind in _FOLLOWS[state]:
                yield "K", CUT_SHORT * short, i + 1, kind
            yield "R", REROLE + CUT_SHORT * short, i + 1, _NEXT[state]

    def run(self, start: int, goal: int) -> tuple[float, str]:
        """Least cost from one state to another (or to acceptance) and the ASCII-least audit of that cost."""
        n = len(self.turns)
        needed: dict[tuple[int, int], float] = {}

        def need(i: int, state: int) -> float:
            known = needed.get((i, state))
            return self.least(i, state, goal) if known is None else known

        def done(i: int, state: int) -> bool:
            return i == n and (state in (EMPTY, ASSISTANT) if goal == ACCEPTED else state == goal)

        bound = need(0, start)
        while bound < _INFINITY:
            if done(0, start):
                return 0, ""
            # A level: turn, state, cost left, edits to try, cost needed as far as is known.
            levels = [[0, start, bound, self.moves(0, start, goal), _INFINITY]]
            letters: list[str] = []
            while levels:
                level = levels[-1]
                i, state, left, moves, best = level
                for letter, cost, j, following in moves:
                    rest = need(j, following)
                    if cost + rest > left:
                        level[4] = min(level[4], cost + rest)
                        continue
                    letters.append(letter)
                    if done(j, following):
                        return bound, "".join(letters)
                    levels.append([j, following, left - cost, self.moves(j, following, goal), _INFINITY])
                    break
                else:
                    needed[i, state] = max(need(i, state), level[4])
                    levels.pop()
                    if levels:
                        before = levels[-1]
                        before[4] = min(before[4], before[2] - left + needed[i, state])
                        letters.pop()
            bound = needed[0, start]
        return _INFINITY, ""


def repaired(turns: list[tuple[str, str]], audit: str, state: int) -> Iterator[str]:
    """The turns `role:text` that the edits of an audit leave, from a state on."""
    at = 0
    for letter in audit:
        if letter == "I":
            state = _NEXT[state]
            yield f"{_ROLE[state]}:"
            continue
        role, text = turns[at]
        at += 1
        if letter == "D":
            continue
        if letter == "R":
            state = _NEXT[state]
            role = _ROLE[state]
        else:
            state = _CLASS[role[:1]]
        yield f"{role}:{text}"


def _counted(turns: list[tuple], names: list[str]) -> list[int]:
    """Gaps, faults and illegal neighbours of turns (turn, role, text) in order."""
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = numbers[-1] - numbers[0] + 1 - len(set(numbers)) if numbers else 0
    first = [role[:1] for _, role, _ in turns]
    illegal = sum(a + b not in _LEGAL for a, b in zip(first, first[1:]))
    return [gaps, *(names.count(name) for name in _COUNTS[1:4]), illegal]


def _judged(turns: list[tuple], seen: set[int] | None = None) -> list[tuple[int, bool, bool, str]]:
    """Faults of turns; `seen` are places known to be duplicates, else all earlier turns are here."""
    known: set[tuple[str, str]] = set()
    found = []
    for i, (_, role, text) in enumerate(turns):
        found.append(faults(role, text, i in seen if seen is not None else (role, text) in known))
        known.add((role, text))
    return found


def repair(turns: list[tuple]) -> list:
    """The values of `RESULT` for one whole conversation of (turn, role, text) in order."""
    judged = _judged(turns)
    cost, audit = Search([j[:3] for j in judged]).run(EMPTY, ACCEPTED)
    left = "\n".join(repaired([t[1:] for t in turns], audit, EMPTY))
    return [*_counted(turns, [j[3] for j in judged]), int(cost), audit, hashlib.sha256(left.encode()).hexdigest()]


_TURNS = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
_FIRST = pa.schema(
    [("_c", pa.int64()), ("_null", pa.bool_()), ("_whole", pa.bool_()), ("_pid", pa.int32()), ("_seq", pa.int64())]
    + [(c, pa.string() if c in RESULT[-2:] else pa.int64()) for c in RESULT]
    + [("_turns", _TURNS)]
)
_FIRST_SQL = (
    "_c bigint, _null boolean, _whole boolean, _pid int, _seq bigint, "
    + ", ".join(f"{c} {'string' if c in RESULT[-2:] else 'bigint'}" for c in RESULT)
    + ", _turns array<struct<turn:bigint,role:string,text:string>>"
)


def _batches(rows: Iterator[list], schema: pa.Schema, weigh) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row)
        if size > CHUNK_BYTES or len(held) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _values(batch: pa.RecordBatch, rows: int = 256) -> Iterator[tuple]:
    """Rows of a batch; few of them are Python values at a time."""
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        yield from zip(*(part.column(k).to_pylist() for k in range(part.num_columns)))


def _size(turns: list[dict] | None) -> int:
    return 64 + sum(len(t["role"]) + len(t["text"]) for t in turns or ())


def _chunks(batches, rows: int, size: int) -> Iterator[tuple[tuple, bool, bool, list[tuple]]]:
    """Key, whether it began here, whether it ended here, and turns of the chunks of one sorted partition."""
    key, turns, weight, begun, first = None, [], 0, True, True
    for batch in batches:
        for c, null, gone, turn, role, text in _values(batch):
            if (c, null) != key:
                if key is not None:
                    yield key, begun and not first, True, turns
                    first = False
                key, turns, weight, begun = (c, null), [], 0, True
            if not gone:
                if turns and (len(turns) >= rows or weight >= size):
                    yield key, False, False, turns
                    turns, weight, begun = [], 0, False
                turns.append((turn, role, text))
                weight += len(role) + len(text)
    if key is not None:
        yield key, False, False, turns


def _as_rows(turns: list[tuple]) -> list[dict]:
    return [{"turn": t, "role": r, "text": x} for t, r, x in turns]


def _first_pass(rows: int, size: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()

        def made() -> Iterator[list]:
            for seq, (key, begun, ended, turns) in enumerate(_chunks(batches, rows, size)):
                whole = begun and ended
                values = repair(turns) if whole else [None] * len(RESULT)
                yield [*key, whole, pid, seq, *values, None if whole else _as_rows(turns)]

        yield from _batches(made(), _FIRST, lambda row: _size(row[-1]) + len(row[-3] or ""))

    return run


# --- conversations in several chunks ---------------------------------------------------------------

_SUMMARY = "_costs array<double>, _ranks array<int>, _audits array<string>, _some array<bigint>, _edge array<string>"


def _second_pass(batches) -> Iterator[pa.RecordBatch]:
    """Costs and audits of a chunk for all pairs of states, its counts, and its first and last roles."""
    for batch in batches:
        for values in _values(batch, 1):
            row = dict(zip([*_PLACE, "_turns", "_seen"], values))
            turns = [(t["turn"], t["role"], t["text"]) for t in row["_turns"]]
            judged = _judged(turns, set(row["_seen"] or ()))
            search = Search([j[:3] for j in judged])
            found = [search.run(s, e) for s, e in _PAIRS]
            order = {a: k for k, a in enumerate(sorted({a for c, a in found if c < _INFINITY}))}
            numbers = [t for t, _, _ in turns if t is not None]
            _, *counts = _counted(turns, [j[3] for j in judged])
            some = [*counts, len(turns), min(numbers, default=None), max(numbers, default=None), len(set(numbers))]
            edge = [turns[0][1][:1], turns[-1][1][:1]] if turns else []
            made = [row[c] for c in _PLACE] + [
                [c for c, _ in found],
                [order.get(a, -1) for _, a in found],
                [a for _, a in found],
                some,
                edge,
            ]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(made, _SECOND.types)], schema=_SECOND)


_SECOND = pa.schema(
    [("_c", pa.int64()), ("_null", pa.bool_()), ("_pid", pa.int32()), ("_seq", pa.int64())]
    + [("_costs", pa.list_(pa.float64())), ("_ranks", pa.list_(pa.int32())), ("_audits", pa.list_(pa.string()))]
    + [("_some", pa.list_(pa.int64())), ("_edge", pa.list_(pa.string()))]
)
_BORDERS = (
    "_c bigint, _null boolean, _pid int, _seq bigint, _start int, _pair int, "
    + ", ".join(f"{c} bigint" for c in RESULT[:6])
)


def borders(chunks: pd.DataFrame) -> pd.DataFrame:
    """States at the borders of the chunks of one conversation, and its sums; a small row a chunk."""
    chunks = chunks.sort_values(["_pid", "_seq"]).reset_index(drop=True)
    costs = [dict(zip(_PAIRS, c)) for c in chunks["_costs"]]
    ranks = [dict(zip(_PAIRS, r)) for r in chunks["_ranks"]]
    last = len(chunks) - 1
    to_go = [costs[last][s, ACCEPTED] for s in range(4)]
    ahead = [to_go]
    for cost in reversed(costs[:last]):
        to_go = [min((cost[s, e] + to_go[e] for e in range(4) if (s, e) in cost), default=_INFINITY) for s in range(4)]
        ahead.append(to_go)
    ahead.reverse()
    state, starts, pairs = EMPTY, [], []
    for k, cost in enumerate(costs):
        ends = [ACCEPTED] if k == last else [
            e for e in range(4) if (state, e) in cost and cost[state, e] + ahead[k + 1][e] == ahead[k][state]
        ]
        end = min(ends, key=lambda e: ranks[k][state, e])
        starts.append(state)
        pairs.append(_PAIRS.index((state, end)))
        state = end
    blank = duplicate = truncated = illegal = distinct = 0
    least = most = before = None
    for some, edge in zip(chunks["_some"], chunks["_edge"]):
        b, d, t, i, many, low, high, different = (None if pd.isna(x) else int(x) for x in some)
        blank, duplicate, truncated, illegal = blank + b, duplicate + d, truncated + t, illegal + i
        if many:
            illegal += before is not None and before + edge[0] not in _LEGAL
            before = edge[1]
        if low is not None:
            distinct += different - (most is not None and low == most)  # a turn on both sides of a border counts once
            least, most = low if least is None else least, high
    gaps = most - least + 1 - distinct if most is not None else 0
    done = chunks[_PLACE].assign(_start=starts, _pair=pairs)
    return done.assign(**dict(zip(RESULT, [gaps, blank, duplicate, truncated, illegal, int(ahead[0][EMPTY])])))


_THIRD = pa.schema(
    [f for f in _FIRST if f.name in (*_PLACE, *RESULT[:7])] + [("_text", pa.binary())]
)
_THIRD_SQL = f"_c bigint, _null boolean, _pid int, _seq bigint, {', '.join(f'{c} bigint' for c in RESULT[:6])}, audit string, _text binary"


def _third_pass(batches) -> Iterator[pa.RecordBatch]:
    """Repaired text of each chunk, null if no turn is left; columns as in `_THIRD`, then start and turns."""

    def rows() -> Iterator[list]:
        for batch in batches:
            for *values, start, turns in _values(batch, 1):
                left = [x.encode() for x in repaired([(t["role"], t["text"]) for t in turns], values[-1], start)]
                yield [*values, b"\n".join(left) if left else None]

    yield from _batches(rows(), _THIRD, lambda row: 64 + len(row[-1] or b""))


def _joined(batches) -> Iterator[pa.RecordBatch]:
    """One row per conversation out of its sorted chunks; the hash reads chunk after chunk."""
    schema = pa.schema([f for f in _FIRST if f.name in (*_KEY, *RESULT)])

    def rows() -> Iterator[list]:
        key, audits, digest, some, sums = None, [], None, False, []
        for batch in batches:
            for values in _values(batch, 1):
                row = dict(zip(_THIRD.names, values))
                if (row["_c"], row["_null"]) != key:
                    if key is not None:
                        yield [*key, *sums, "".join(audits), digest.hexdigest()]
                    key, audits, digest, some = (row["_c"], row["_null"]), [], hashlib.sha256(), False
                    sums = [row[c] for c in RESULT[:6]]
                audits.append(row["audit"])
                if row["_text"] is not None:
                    digest.update(b"\n" * some + row["_text"])
                    some = True
        if key is not None:
            yield [*key, *sums, "".join(audits), digest.hexdigest()]

    yield from _batches(rows(), schema, lambda row: 64 + len(row[-2]))


def _in_chunks(parts: DataFrame) -> DataFrame:
    """`_c, _null` and results of the conversations that are not whole in one chunk."""
    turns = parts.select(*_PLACE, F.posexplode("_turns").alias("_i", "_t"))
    keyed = turns.select(*_PLACE, "_i", F.md5(F.to_json(F.struct("_t.role", "_t.text"))).alias("_same"))
    place = F.struct("_pid", "_seq", "_i")
    firsts = keyed.groupBy(*_KEY, "_same").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    seen = (
        keyed.join(firsts, [*_KEY, "_same"])
        .where(place > F.col("_first"))
        .groupBy(*_PLACE)
        .agg(F.collect_list("_i").alias("_seen"))  # a chunk's turns at most
    )
    known = parts.select(*_PLACE, "_turns").join(seen, _PLACE, "left").select(*_PLACE, "_turns", "_seen")
    schema = f"_c bigint, _null boolean, _pid int, _seq bigint, {_SUMMARY}"
    summaries = cut(known.mapInArrow(_second_pass, schema), "summaries")
    small = summaries.drop("_audits")
    decided = small.groupBy(*_KEY).applyInPandas(borders, _BORDERS)
    chosen = summaries.select(*_PLACE, "_audits").join(decided, _PLACE).withColumn("audit", F.get("_audits", F.col("_pair")))
    pieces = (
        chosen.join(parts.select(*_PLACE, "_turns"), _PLACE)
        .select(*_PLACE, *RESULT[:6], "audit", "_start", "_turns")
        .mapInArrow(_third_pass, _THIRD_SQL)
    )
    in_order = pieces.repartition(*_KEY).sortWithinPartitions(*_PLACE)
    return in_order.mapInArrow(_joined, _THIRD_SQL.replace("_pid int, _seq bigint, ", "").replace("_text binary", "repaired_sha256 string"))


def damage(conversations: DataFrame) -> DataFrame:
    """`conv_id, turn, role, text, gone, copy`: each turn damaged by the checksum of `conv_id:turn`, modulo 20.

    0 drops it (the row stays with `gone`), 1 empties the text, 2 removes its ends of sentences, 3 repeats
    it, 4 makes it a user's. Nulls are one space in the checksum, the role and the text.
    """
    space = F.lit(" ")
    conv, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    key = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    made = conversations.select(
        conv.alias("conv_id"),
        turn.alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), space)).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate(text, _ENDS, "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return made.select("conv_id", "turn", "role", "text", "gone", F.explode("copies").alias("copy"))


def repair_conversations(turns: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per `conv_id` of `turns` (columns `conv_id, turn, role, text`, and `gone, copy` if there).

    `gaps, blank, duplicate, truncated, illegal, cost` are longs, `audit` the letters of the edits, and
    `repaired_sha256` the hash of the repaired turns. Rows with `gone` are no turns, but their conversation
    is returned. Turns stand by `turn`, nulls first; turns of one number by role, then a hash of the text.

    Null roles and texts are one space; a null `conv_id` is a conversation of its own. Repeated rows are
    duplicates of the first. Further columns are ignored, whatever their names. A conversation without
    turns has zeros, an empty audit and the hash of the empty string. An empty table gives an empty
    one. A text is held in one piece; conversations are cut into chunks of at most `chunk_rows` turns, or
    the turn after which a chunk holds `chunk_bytes`. The hash of one conversation is a sequence by its nature: one task
    reads its repaired chunks, one after the other.
    """
    space = F.lit(" ")
    taken = {c.lower() for c in turns.columns}
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("_c"),
        F.col("conv_id").isNull().alias("_null"),
        (F.coalesce(F.col("gone"), F.lit(False)) if "gone" in taken else F.lit(False)).alias("_gone"),
        F.col("turn").cast("bigint").alias("_turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("_role"),
        F.coalesce(F.col("text").cast("string"), space).alias("_text"),
        (F.col("copy") if "copy" in taken else F.lit(0)).cast("int").alias("_copy"),
    ).withColumn("_hash", F.xxhash64("_text"))
    order = ["_c", "_null", F.col("_turn").asc_nulls_first(), "_role", "_hash", "_copy"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    read = dealt.select(*_KEY, "_gone", "_turn", "_role", "_text")
    done = cut(read.mapInArrow(_first_pass(chunk_rows, chunk_bytes), _FIRST_SQL), "conversations")
    whole = done.where("_whole").select(*_KEY, *RESULT)
    parts = done.where("NOT _whole").select(*_PLACE, "_turns")
    return whole.unionByName(_in_chunks(parts)).select(
        F.when(~F.col("_null"), F.col("_c")).alias("conv_id"), *RESULT
    )
