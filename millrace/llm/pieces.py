"""SentencePiece encoding and decoding as a shortest path through a weighted transducer.

A model is compiled into three parts that are composed with each input:

* the normaliser: spaces become U+2581, and one is put before a text that is not empty;
* the pieces: an arc for every piece that reads its characters and writes its id, and for a
  character that no piece reads the byte fallback, which writes the ids of its UTF-8 bytes;
* the weights. In a unigram model an arc weighs minus its score. In a BPE model an acceptor of
  neighbouring pieces weighs 0 where merging their joined text leaves just the two, infinity
  elsewhere; exactly one path is then finite, the one the merges give.

The answer is the least sum of weights (tropical semiring), found position by position. As no piece
reads a character after which the next could begin with U+2581, paths fall apart into words there,
and each distinct word of a task is solved once while the table of solved words has room.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession, functions as F

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# Words some 40 MB a worker when full; then the older half goes. Half as many take twice the time.
_WORDS_KEPT = 250_000
# Pairs of ids take 9 bytes each, touched as they come; of pairs of strings a sixteenth is kept, some 10 MB.
_PAIRS_KEPT = 1 << 20
_GROUP_BYTES = 1 << 20
_LONGEST_KEPT = 40
_WORDS_AT_ONCE = 16_384
_INFINITY = float("inf")


def _fields(data: bytes):
    """Number and value of the fields of one protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = number()
        field, kind = key >> 3, key & 7
        if kind == 0:
            yield field, number()
        else:
            size = number() if kind == 2 else 8 if kind == 1 else 4
            yield field, data[at : at + size]
            at += size


# The model's kinds of pieces and of models.
_NORMAL, _UNKNOWN, _USER, _UNUSED, _BYTE = 1, 2, 4, 5, 6
_UNIGRAM, _BPE = 1, 2


_STEP = 0x9E3779B97F4A7C15


def _name(text: str) -> int:
    name = 0
    for c in text:
        name = ((name + ord(c) + 1) * _STEP) % (1 << 64)
        name ^= name >> 29
    return name


def _keep(table: dict, limit: int, more: int = 1) -> None:
    """Make room: when a table would be over its limit, its older half goes, or all if that is not enough."""
    if len(table) + more > limit:
        half = len(table) // 2 if len(table) // 2 + more <= limit else len(table)
        for key in list(islice(table, half)):
            del table[key]


class Transducer:
    """A compiled model: `encode` a text to the bytes of int32 ids, `decode` ids to a text."""

    def __init__(self, model: bytes):
        self.texts: list[str] = []
        kinds, scores, rules, trainer = [], [], {}, {}
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                self.texts.append(piece[1].decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(piece.get(3, _NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                rules = dict(_fields(value))
        if rules.get(2):
            raise ValueError("models with a character map are not supported")
        self.kind = trainer.get(3, _UNIGRAM)
        if self.kind not in (_UNIGRAM, _BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.prefix = bool(rules.get(3, 1))
        self.squeeze = bool(rules.get(4, 1))
        self.ids = {t: i for i, t in enumerate(self.texts) if kinds[i] in (_NORMAL, _USER, _UNUSED)}
        self.scores = {t: scores[i] for t, i in self.ids.items()}
        self.bytes = {int(self.texts[i][3:5], 16): i for i, k in enumerate(kinds) if k == _BYTE}
        self.unknown = next((i for i, k in enumerate(kinds) if k == _UNKNOWN), 0)
        #: Beginnings of pieces, and whether they are pieces.
        self.beginnings = {t[:k]: False for t in self.ids for k in range(1, len(t))} | dict.fromkeys(self.ids, True)
        self.longest = max(map(len, self.ids), default=1)
        self.floor = min(self.scores.values(), default=0.0) - 10.0
        whole = any(SPACE in t.lstrip(SPACE) for t in self.ids)
        inner = "" if any("\n" in t for t in self.ids) else "\n"
        # Stretches between which no piece reaches.
        self.split = re.compile(
            r"(?s).+" if whole else f"{SPACE}*[^{SPACE}{inner}]+|{SPACE}+" + (f"|{inner}" if inner else "")
        )
        self.solved: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.built: dict[str, list | None] = {}
        #: Names of all beginnings in order, and the id of the piece they are (or -1).
        at = sorted((_name(t), self.ids.get(t, -1)) for t in self.beginnings)
        self.known_names = np.array([n for n, _ in at], dtype=np.uint64)
        self.known_ids = np.array([i for _, i in at], dtype=np.int64)
        #: Pairs of ids asked for in bulk, 1 added: each has one place, where the last that falls there stays.
        self.code_bits = _PAIRS_KEPT.bit_length() - 1
        self.codes = np.zeros(1 << self.code_bits, dtype=np.int64)
        self.code_fits = np.zeros(1 << self.code_bits, dtype=bool)
        self.output = [t.replace(SPACE, " ").encode() for t in self.texts]
        for i, kind in enumerate(kinds):
            if kind == _BYTE:
                self.output[i] = bytes([int(self.texts[i][3:5], 16)])
            elif kind not in (_NORMAL, _USER, _UNUSED):
                self.output[i] = " ⁇ ".encode() if kind == _UNKNOWN else b""

    # --- weights ---------------------------------------------------------------------------------

    def merges(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """What merging leaves of a short text, best-scored neighbours first and the leftmost of
        equals; and of each merge in turn its score and the first and last part after it."""
        parts, steps = list(text), []
        while True:
            best, at = -_INFINITY, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and score > best:
                    best, at = score, i
            if at < 0:
                return parts, steps
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            steps.append((best, parts[0], parts[-1]))

    def shared(self, piece: str) -> str:
        """The model's own copy of a piece, so that tables hold no further ones."""
        at = self.ids.get(piece)
        return piece if at is None else self.texts[at]

    def history(self, piece: str) -> list[tuple[float, str, str]] | None:
        """The merges that build a piece, ended by a step that never comes; None if they do not build it."""
        if piece not in self.built:
            parts, steps = self.merges(piece)
            whole = self.shared(piece)
            steps = [(score, self.shared(first), self.shared(last)) for score, first, last in steps]
            self.built[whole] = [*steps, (-_INFINITY, whole, whole)] if len(parts) == 1 else None
        return self.built[piece]

    def allowed(self, left: str, right: str) -> bool:
        """`accepted`, kept for pairs that long or rare words ask for; words solved in bulk keep `codes`."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            _keep(self.pairs, _PAIRS_KEPT // 16)
            known = self.pairs[self.shared(left), self.shared(right)] = self.accepted(left, right)
        return known

    def accepted(self, left: str, right: str) -> bool:
        """Whether the pair acceptor lets `right` follow `left`: no merge ever joins across their border.

        Both are built side by side, the better-scored merge first; the parts at the border merge
        as soon as their score beats what is next on both sides.
        """
        a, b = self.history(left), self.history(right)
        if a is None or b is None:
            return False
        i = j = 0
        last, first = left[-1], right[0]
        while True:
            ahead, behind = a[i][0], b[j][0]
            across = self.scores.get(last + first)
            if across is not None and across > ahead and across >= behind:
                return False
            if ahead == behind == -_INFINITY:
                return True
            if ahead >= behind:
                last = a[i][2]
                i += 1
            else:
                first = b[j][1]
                j += 1

    def finite_path(self, text: str) -> list[str]:
        """The one path of finite weight, depth first and longest arcs first.

        A finite path to a position is what merging leaves of the text up to there, so there is
        one at most and no position is tried twice.
        """
        n, pairs, beginnings = len(text), self.pairs, self.beginnings
        dead = set()
        path: list[str] = []
        waiting: list[list[str]] = []  # arcs not tried yet, the longest last
        at, before = 0, ""
        arcs = None
        while at < n:
            if arcs is None:
                arcs = [text[at]]
                end = at + 1
                while end <= n:
                    piece = text[at:end]
                    whole = beginnings.get(piece)
                    if whole is None:
                        break
                    if whole and end > at + 1:
                        arcs.append(piece)
                    end += 1
            while arcs:
                piece = arcs.pop()
                known = pairs.get((before, piece)) if before else self.history(piece) is not None
                if known is None:
                    known = self.allowed(before, piece)
                if known and at + len(piece) not in dead:
                    break
            else:
                if not path:
                    return self.merges(text)[0]
                dead.add(at)
                at -= len(path.pop())
                arcs = waiting.pop()
                before = path[-1] if path else ""
                continue
            path.append(piece)
            waiting.append(arcs)
            at += len(piece)
            before, arcs = piece, None
        return path

    def path(self, text: str) -> list[str]:
        """Pieces (or single unread characters) of the lightest path through one stretch."""
        if self.kind == _BPE:
            return self.finite_path(text)
        n, longest = len(text), self.longest
        back = [""] * (n + 1)
        least = [0.0] + [_INFINITY] * n
        for end in range(1, n + 1):
            for start in range(max(0, end - longest), end):
                piece = text[start:end]
                weight = -self.scores[piece] if piece in self.ids else -self.floor if end - start == 1 else _INFINITY
                if least[start] + weight < least[end]:
                    least[end], back[end] = least[start] + weight, piece
        parts = []
        while n:
            parts.append(back[n])
            n -= len(back[n])
        return parts[::-1]

    # --- input and output ----------------------------------------------------------------------

    def solve(self, text: str) -> bytes:
        found: list[int] = []
        for piece in self.path(text):
            at = self.ids.get(piece)
            if at is not None:
                found.append(at)
            elif self.bytes:
                found.extend(self.bytes[b] for b in piece.encode("utf-8", "surrogatepass"))
            elif not found or found[-1] != self.unknown:
                found.append(self.unknown)
        ids = array("i", found).tobytes()
        if len(text) <= _LONGEST_KEPT:
            _keep(self.solved, _WORDS_KEPT)
            self.solved[text] = ids
        return ids

    def solve_all(self, words: list[str]) -> None:
        """Solve many short words, some thousands of similar length at a time."""
        words = sorted(words, key=len)
        for at in range(0, len(words), _WORDS_AT_ONCE):
            self._solve_together(words[at : at + _WORDS_AT_ONCE])

    def _solve_together(self, words: list[str]) -> None:
        """The finite paths of words ordered by length, advanced place by place.

        Words with characters that no piece reads, and long ones, are left to `solve`.
        """
        n, width = len(words), len(words[-1])
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
        chars = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(n, width)
        last = np.full((n, width + 1), -1, dtype=np.int32)
        step, shift = np.uint64(_STEP), np.uint64(29)
        for start in range(width):
            rows = np.flatnonzero((sizes > start) & ((last[:, start] >= 0) | (start == 0)))
            names = np.zeros(len(rows), dtype=np.uint64)
            for end in range(start + 1, width + 1):
                inside = sizes[rows] >= end
                rows, names = rows[inside], names[inside]
                names = (names + chars[rows, end - 1].astype(np.uint64) + np.uint64(1)) * step
                names ^= names >> shift
                at = np.minimum(np.searchsorted(self.known_names, names), len(self.known_names) - 1)
                known = self.known_names[at] == names
                rows, names, piece = rows[known], names[known], self.known_ids[at[known]]
                if not len(rows):
                    break
                whole = np.flatnonzero(piece >= 0)
                if not len(whole):
                    continue
                before = last[rows[whole], start].astype(np.int64)
                codes, which = np.unique(((before + 1) << 32) | piece[whole], return_inverse=True)
                fits = self._fit(codes)[which]
                last[rows[whole[fits]], end] = piece[whole[fits]]
        lengths = np.array([len(t) for t in self.texts])
        place, many = sizes.copy(), np.zeros(n, dtype=np.int64)
        live = np.flatnonzero(last[np.arange(n), sizes] >= 0)
        done = live
        found = []
        while len(live):
            piece = last[live, place[live]]
            found.append((live, many[live], piece))
            place[live] -= lengths[piece]
            many[live] += 1
            live = live[place[live] > 0]
        ends = np.cumsum(many)
        flat = np.empty(int(ends[-1]), dtype=np.int32)
        for rows, back, piece in found:
            flat[ends[rows] - 1 - back] = piece
        raw, solved = flat.tobytes(), self.solved
        _keep(solved, _WORDS_KEPT, len(done))
        stop = (4 * ends).tolist()
        for row in done.tolist():
            solved[words[row]] = raw[stop[row - 1] if row else 0 : stop[row]]

    def _fit(self, codes: np.ndarray) -> np.ndarray:
        """Whether the right piece of each pair (the left id plus 1, 0 for none, in the upper bits) may follow the left."""
        place = (codes.astype(np.uint64) * np.uint64(_STEP) >> np.uint64(64 - self.code_bits)).astype(np.int64)
        fits = self.code_fits[place]
        new = np.flatnonzero(self.codes[place] != codes + 1)
        texts = self.texts
        for row, code in zip(new.tolist(), codes[new].tolist()):
            left, right = (code >> 32) - 1, texts[code & 0xFFFFFFFF]
            fits[row] = self.history(right) is not None if left < 0 else self.accepted(texts[left], right)
        # Of new pairs with one place the last is kept: the same one for both arrays.
        kept = new[len(new) - 1 - np.unique(place[new][::-1], return_index=True)[1]]
        self.codes[place[kept]], self.code_fits[place[kept]] = codes[kept] + 1, fits[kept]
        return fits

    def forget(self) -> None:
        """Give up the solved words and pairs of strings. Workers outlive a task and hold what it leaves in
        the stages after it, too; words come back within a megabyte or two of text."""
        self.solved.clear()
        self.pairs.clear()

    def encode_all(self, texts: list[str | None]) -> list[bytes | None]:
        """`encode` for many texts; words not met before are solved together."""
        words = [None if t is None else self.split.findall(self.normalised(t)) for t in texts]
        solved = self.solved
        if self.kind == _BPE:
            new = {w for w in set().union(*filter(None, words)) if w not in solved and len(w) <= _LONGEST_KEPT}
            # Characters 0 at the end of a word are lost in a fixed-width array.
            self.solve_all([w for w in new if "\0" not in w])
        return [None if found is None else self.joined(found) for found in words]

    def joined(self, words: list[str]) -> bytes:
        try:
            return b"".join(map(self.solved.get, words))
        except TypeError:  # some are not solved, or not kept
            return b"".join([self.solved.get(w) or self.solve(w) for w in words])

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """Ids of an Arrow array of texts, worked on in groups of bounded size."""
        encoded: list[bytes | None] = []
        for part in groups(texts, pc.binary_length(texts), _GROUP_BYTES):
            encoded += self.encode_all(part.to_pylist())
        ends = np.cumsum([0 if e is None else len(e) // 4 for e in encoded], dtype=np.int64)
        flat = np.frombuffer(b"".join([e for e in encoded if e]), dtype=np.int32)
        missing = pa.array([e is None for e in encoded], pa.bool_())
        return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(flat), mask=missing)

    def decode_array(self, ids: pa.Array) -> pa.Array:
        """`decode` for an Arrow array of ids: the bytes of all pieces of a group are gathered at once."""
        n = len(self.output)
        table = pa.array([*self.output, b""], pa.large_binary())
        decoded: list[str | None] = []
        for part in groups(ids, pc.list_value_length(ids), _GROUP_BYTES // 4):
            sizes = np.asarray(pc.fill_null(pc.list_value_length(part), 0), dtype=np.int64)
            each = np.asarray(pc.fill_null(part.flatten().cast(pa.int64()), -1))
            taken = table.take(pa.array(np.where((each >= 0) & (each < n), each, n)))
            data = taken.buffers()[2]
            raw = data.to_pybytes() if data is not None else b""
            places = np.frombuffer(taken.buffers()[1], dtype=np.int64, count=len(taken) + 1)
            bounds = places[np.r_[0, np.cumsum(sizes)]].tolist()
            for row, there in enumerate(part.is_valid().to_pylist()):
                decoded.append(self.text_of(raw[bounds[row] : bounds[row + 1]]) if there else None)
        return pa.array(decoded, pa.string())

    def normalised(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (" " * self.prefix + text).replace(" ", SPACE)

    def encode(self, text: str) -> bytes:
        return self.joined(self.split.findall(self.normalised(text)))

    def decode(self, ids: list[int]) -> str:
        """Text of ids; ids the model lacks are skipped, bytes that are no UTF-8 become U+FFFD."""
        output, n = self.output, len(self.output)
        try:
            joined = b"".join([output[i] for i in ids]) if min(ids, default=0) >= 0 else None
        except (IndexError, TypeError):
            joined = None
        if joined is None:
            joined = b"".join([output[i] for i in ids if i is not None and 0 <= i < n])
        return self.text_of(joined)

    def text_of(self, joined: bytes) -> str:
        text = joined.decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def groups(values: pa.Array, sizes: pa.Array, limit: int):
    """Slices of an array whose rows add up to `limit` at most, or one row."""
    ends = np.cumsum(np.asarray(pc.fill_null(sizes, 0), dtype=np.int64))
    row = 0
    while row < len(ends):
        before = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield values.slice(row, stop - row)
        row = stop


def in_groups(batches: Iterator[pa.Array], sizes: Callable, limit: int, work: Callable) -> Iterator[pa.Array]:
    """`work` on groups of bounded size; each result is sent on before the next group is worked on.

    Arrow keeps what a batch has taken and given back; it goes before the next batch.
    """
    for values in batches:
        for part in groups(values, sizes(values), limit):
            yield work(part)
        pa.default_memory_pool().release_unused()


def in_task(transducer: Transducer, batches: Iterator[pa.Array], sizes: Callable, limit: int, work: Callable) -> Iterator[pa.Array]:
    """`in_groups` over the batches of a task; the tables that grew with them go at its end."""
    yield from in_groups(batches, sizes, limit, work)
    transducer.forget()


@lru_cache(maxsize=2)
def compiled(model: bytes) -> Transducer:
    return Transducer(model)


def read_model(path: str = MODEL_PATH) -> bytes:
    """A model file (half a megabyte for 32,000 pieces), read once on the driver."""
    with open(path, "rb") as file:
        return file.read()


def encode(spark: SparkSession, text: Column, model_path: str = MODEL_PATH) -> Column:
    """Ids of a text as array<int>; null for null, no ids for an empty text.

    Whole texts of any length are encoded; characters without a piece become bytes. The model is
    broadcast: its size depends on the vocabulary alone.
    """
    shared = spark.sparkContext.broadcast(read_model(model_path))

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        transducer = compiled(shared.value)
        return in_task(transducer, batches, pc.binary_length, _GROUP_BYTES, transducer.encode_array)

    return run(text.cast("string"))


def decode(spark: SparkSession, ids: Column, model_path: str = MODEL_PATH) -> Column:
    """Text of ids; null for null. `decode(encode(t))` is t with U+2581 read as a space."""
    shared = spark.sparkContext.broadcast(read_model(model_path))

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return in_groups(batches, pc.list_value_length, _GROUP_BYTES // 4, compiled(shared.value).decode_array)

    return run(ids)


def round_trip(spark: SparkSession, text: Column, model_path: str = MODEL_PATH) -> Column:
    """`encode` and `decode` of those ids as struct(ids, decoded); both null for null.

    One pass through Python: two nested calls of which both results are kept would encode twice.
    """
    shared = spark.sparkContext.broadcast(read_model(model_path))

    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        transducer = compiled(shared.value)

        def both(part: pa.Array) -> pa.Array:
            ids = transducer.encode_array(part)
            return pa.StructArray.from_arrays([ids, transducer.decode_array(ids)], ["ids", "decoded"])

        return in_task(transducer, batches, pc.binary_length, _GROUP_BYTES, both)

    return run(text.cast("string"))
