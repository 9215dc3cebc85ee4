"""What the operators share: written intermediate tables, Arrow slices, names of byte strings.

Work inside tasks runs on slices of bounded size, so that a task needs the same memory for a
partition of many short texts, of few long ones, or of any number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import new_folder

SLICE_BYTES = 1 << 20
HELD_OUT_PARTS = 5
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: no lineage, no executor-local blocks.

    The shuffle files of the write are given up as soon as it ends, for nothing reads them again.
    """
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text divides by five.

    A null id is never held out (and never trained on, see `trainable`).
    """
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT_PARTS == 0, F.lit(False))


def trainable(doc_id: Column) -> Column:
    """Whether labels of a document may be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT_PARTS != 0, F.lit(False))


def as_bytes(column: str) -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def slices(batches, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of Arrow batches with at most `limit` bytes of `column` (or one row), its bytes and row bounds."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        if values.null_count:
            values = pc.fill_null(values, b"")
        values = values.cast(pa.large_binary())
        sizes = np.asarray(pc.fill_null(pc.binary_length(values), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        row = 0
        while row < len(sizes):
            before = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, before + limit, "right")))
            part = values.slice(row, stop - row)
            bounds = np.frombuffer(part.buffers()[1], dtype=np.int64, count=len(part) + 1, offset=8 * part.offset)
            data = part.buffers()[2]
            raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
            yield batch.slice(row, stop - row), raw[bounds[0] : bounds[-1]], bounds - bounds[0]
            row = stop


def texts(values: pa.Array) -> list[bytes]:
    """Python bytes of a binary column, null as empty."""
    return [v or b"" for v in values.to_pylist()]


# --- names: equal byte strings have equal names --------------------------------------------------

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_BASES = (0x5851F42D4C957F2D, 0xD1342543DE82EF95)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; equal stay equal."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base modulo 2^64, and of its inverse, for n places."""
    known = _POWERS.get(which)
    if known is None or len(known[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        both = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            both.append(np.multiply.accumulate(factors))
        known = (both[0], both[1])
        if n <= SLICE_BYTES * 2:
            _POWERS[which] = known
    return known


class Names:
    """Names of all stretches of a sequence of 64-bit values, from prefix sums of a polynomial."""

    def __init__(self, values: np.ndarray, which: int = 0):
        n = len(values)
        self.inverse = _powers(which, n + 1)[1]
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * _powers(which, n + 1)[0][:n], out=self.sums[1:])
        self.salt = _MIX[which]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = (end - start).astype(np.uint64)
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start] + size * self.salt)


def byte_values(which: int) -> np.ndarray:
    """A fixed 64-bit value for each byte."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * _MIX[which])


BYTE_VALUES = (byte_values(0), byte_values(1))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` consecutive values, by minima from both ends of blocks of that width."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def least_places(order: np.ndarray, width: int) -> np.ndarray:
    """Place of the least (leftmost among equals) of each `width` consecutive 64-bit values."""
    bits = np.uint64(max(1, int(len(order)).bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    packed = (order & ~mask) | np.arange(len(order), dtype=np.uint64)
    return (sliding_min(packed, width) & mask).astype(np.int64)


# The bytes that part words, space and \x09 to \x0D.
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word `[^\\x20\\x09-\\x0D]+`; words end where their row ends."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _IN_WORD[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[bounds] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1
