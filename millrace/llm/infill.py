"""Fill-in-middle transformation by displacement scatter, and its inverse by gather.

A text is cut at two code points into prefix, middle and suffix, which are written in another order
behind sentinels. No text is taken apart for that: of a slice of texts, laid end to end as bytes, the cuts
are scanned once; at the first byte of every part stands the difference between the displacement of
that part and of the part before; the running sum of the differences is the displacement of every
byte, and one numpy scatter puts all bytes of all texts where they belong. The inverse finds the
sentinels in the output, sums up the opposite differences and gathers the bytes.

Displacements are made for a block of bytes at a time, so one very long text needs the same memory
for them as many short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import as_bytes, slices
from millrace.llm.lines import fresh

# The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = np.frombuffer((PREFIX + SUFFIX + MIDDLE).encode(), np.uint8).reshape(3, 3)
FORMS = ("plain", "psm", "spm")
_BLOCK = 1 << 20


def _displacements(total: int, starts: np.ndarray, shifts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Blocks (from, to, displacement of each byte), given where parts start and how far each is moved.

    Parts stand in order; an empty part starts where the next does, and its difference is cancelled there.
    """
    steps = np.diff(shifts, prepend=0)
    edges = np.searchsorted(starts, np.minimum(np.arange(0, total + _BLOCK, _BLOCK), total))  # what starts at the end is empty
    carried = 0
    for block, at in enumerate(range(0, total, _BLOCK)):
        end = min(total, at + _BLOCK)
        mine = slice(edges[block], edges[block + 1])
        difference = np.zeros(end - at, dtype=np.int64)
        np.add.at(difference, starts[mine] - at, steps[mine])
        difference[0] += carried
        moved = np.cumsum(difference)
        carried = int(moved[-1])
        yield at, end, moved


def _heads(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of code points, and how many of them stand before each bound."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    return heads, np.searchsorted(heads, bounds)


def _cut_bytes(heads: np.ndarray, before: np.ndarray, bounds: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Byte at which each row's cut, given in code points, lies."""
    inside = cuts < np.diff(before)
    found = bounds[1:].copy()
    found[inside] = heads[(before[:-1] + cuts)[inside]]
    return found


def _sentinels(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sentinels start, and in which row; none spans two rows."""
    spots = np.flatnonzero(data[:-2] == _MARKS[0, 0]) if len(data) > 2 else np.empty(0, np.int64)
    spots = spots[np.isin(data[spots + 1], _MARKS[:, 1]) & (data[spots + 2] == _MARKS[0, 2])]
    row = np.searchsorted(bounds, spots, "right") - 1
    whole = spots + 3 <= bounds[row + 1]
    return spots[whole], row[whole]


def scatter(data: np.ndarray, bounds: np.ndarray, low: np.ndarray, high: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs of a slice, end to end, and their bounds; form 0 is plain, 1 is psm, 2 is spm."""
    begin, end = bounds[:-1], bounds[1:]
    cut = form > 0
    heads, before = _heads(data, bounds)
    a, b = (np.where(cut, _cut_bytes(heads, before, bounds, c), end) for c in (low, high))
    out = np.zeros(len(bounds), dtype=np.int64)
    np.cumsum(end - begin + 9 * cut, out=out[1:])
    at = out[:-1]
    swapped = form == 2
    tail = end - b
    to_prefix = at + np.where(swapped, 6 + tail, 3 * cut)
    to_suffix = at + np.where(swapped, 3, 6 + a - begin)
    to_middle = at + 9 + (a - begin) + tail
    starts = np.stack([begin, a, b], axis=1)
    shifts = np.stack([to_prefix - begin, to_middle - a, to_suffix - b], axis=1)
    # What is not cut has one part; the others end where it ends and move nothing.
    shifts[~cut, 1:] = shifts[~cut, :1]
    made = np.empty(int(out[-1]), dtype=np.uint8)
    for s, e, moved in _displacements(len(data), starts.ravel(), shifts.ravel()):
        made[np.arange(s, e) + moved] = data[s:e]
    for mark, places in zip(_MARKS, (to_prefix, to_suffix, to_middle)):
        for k in range(3):
            made[places[cut] - 3 + k] = mark[k]
    return made, out


def gather(made: np.ndarray, bounds: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts rebuilt from outputs and forms alone, end to end, and their bounds."""
    cut = form > 0
    spots, row = _sentinels(made, bounds)
    spots = spots[cut[row]].reshape(-1, 3)  # each output that is cut has just three
    begin, end = bounds[:-1], bounds[1:]
    out = np.zeros(len(bounds), dtype=np.int64)
    np.cumsum(end - begin - 9 * cut, out=out[1:])
    parts = np.repeat(begin[:, None], 3, axis=1)  # first bytes of prefix, middle and suffix in the output
    sizes = np.zeros((len(begin), 3), dtype=np.int64)
    sizes[:, 0] = end - begin
    one, two, three = spots.T
    swapped = form[cut] == 2
    head, tail = np.where(swapped, two, one) + 3, np.where(swapped, one, two) + 3
    head_end, tail_end = np.where(swapped, three, two), np.where(swapped, two, three)
    parts[cut] = np.stack([head, three + 3, tail], axis=1)
    sizes[cut] = np.stack([head_end - head, end[cut] - three - 3, tail_end - tail], axis=1)
    starts = out[:-1, None] + np.cumsum(sizes, axis=1) - sizes
    text = np.empty(int(out[-1]), dtype=np.uint8)
    for s, e, moved in _displacements(len(text), starts.ravel(), (parts - starts).ravel()):
        text[s:e] = made[np.arange(s, e) + moved]
    return text, out


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds)), pa.py_buffer(data)]
    ).cast(pa.binary())


_MADE = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.binary()}


def _transform(part: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray, transformed: int, spm: int) -> pa.StructArray:
    """The struct of new columns of a slice; `digest` has the four numbers of a row in hexadecimal."""
    drawn = np.array([[int(d[k : k + 8], 16) for k in (0, 8, 16, 24)] for d in part.column("digest").to_pylist()]).reshape(-1, 4)
    n = np.diff(_heads(data, bounds)[1])
    cuts = np.sort(drawn[:, :2] % (n[:, None] + 1), axis=1)
    plain = (n == 0) | (drawn[:, 2] % 100 >= transformed)
    plain[_sentinels(data, bounds)[1]] = True
    form = np.where(plain, 0, np.where(drawn[:, 3] % 100 < spm, 2, 1))
    columns = [
        pa.array(n),
        pa.array(np.array(FORMS, dtype=object)[form], pa.string()),
        pa.array(cuts[:, 0], mask=plain),
        pa.array(cuts[:, 1] - cuts[:, 0], mask=plain),
        _binary(*scatter(data, bounds, cuts[:, 0], cuts[:, 1], form)),
    ]
    return pa.StructArray.from_arrays(columns, names=list(_MADE))


def _restore(part: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    form = np.array([FORMS.index(f) if f in FORMS else 0 for f in part.column("form").to_pylist()], dtype=np.int64)
    return _binary(*gather(data, bounds, form))


def _in_slices(work, kind: pa.DataType, returned: str):
    """A UDF of one struct column that has bytes as `text`, worked on in slices of bounded size."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            done = [work(*part) for part in slices([pa.RecordBatch.from_struct_array(batch)], "text")]
            yield pa.concat_arrays(done) if done else pa.array([], kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returned)


def fill_in_middle(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: str = "1",
    transformed: int = 90,
    spm: int = 20,
) -> DataFrame:
    """The rows of `docs` with `n, form, prefix_chars, middle_chars` (longs, form a string) and `output` (binary).

    Cuts and form are drawn by the hex SHA-256 of `seed:id`: its first two 8-digit groups, modulo n + 1,
    are the cuts in code points, the third decides whether the text is transformed (`transformed` of 100),
    the fourth the order (`spm` of 100). Texts that are empty or hold a sentinel stay plain.

    A null text is empty; a null id is drawn as an empty one. Rows with equal ids and texts have
    equal outputs. Whole texts are cut, however long. New columns take the place of columns of the same
    name; all others pass through. An empty table gives an empty one.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    work = _in_slices(
        lambda part, data, bounds: _transform(part, data, bounds, transformed, spm),
        pa.struct(list(_MADE.items())),
        "n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary",
    )
    made = work(F.struct(as_bytes(text_column).alias("text"), digest.alias("digest")))
    key = fresh(docs, "_made")
    return docs.withColumn(key, made).withColumns({name: F.col(f"`{key}`.{name}") for name in _MADE}).drop(key)


def restored(output: str = "output", form: str = "form") -> Column:
    """Binary column: the exact text rebuilt from an output and its form; a null output is empty."""
    return _in_slices(_restore, pa.binary(), "binary")(
        F.struct(F.coalesce(F.col(output), F.lit(b"")).alias("text"), F.col(form).alias("form"))
    )
