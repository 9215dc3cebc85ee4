"""Removal of long byte strings that occur twice: ranks of suffixes at growing lengths, doubled
only where they are not yet unique.

Dense prefix doubling needs a row per byte and round. Here the positions are thinned by content: a
window of `size` bytes is filed under the least 8-byte word in its middle half, which equal windows
share, so one row stands for all windows filed there (about one per 100 bytes). Ranks are names of
the bytes, compared by Spark at growing lengths: first the 200 bytes around a position, which every
window filed there holds; then, for positions that are not unique, the bytes common to 32
neighbouring windows, and all bytes those windows cover; at last, where these disagree, the
windows. Positions that become unique, or whose windows all repeat, leave the next round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import BYTE_VALUES, Names, as_bytes, cut, least_places, mixed, slices
from millrace.llm.substrings import among, listed, longs, take_ids

SIZE_BYTES = 400
_BLOCK = 32
_GRAM = 8
_KEY_SHIFT = np.uint64(16)


class ByteWindows:
    """Positions of one slice and, for each, the run of windows filed there."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, size: int):
        self.size, self.data = size, data
        self.margin = size // 4
        n = len(data)
        long = np.flatnonzero(np.diff(bounds) >= size)
        change = np.zeros(n + 2, dtype=np.int32)
        np.add.at(change, bounds[long], 1)
        np.add.at(change, bounds[long + 1] - size + 1, -1)
        starts = np.flatnonzero(np.cumsum(change[:n]) > 0)
        self.places = self.low = self.high = np.empty(0, np.int64)
        if len(starts):
            grams = np.ndarray(n - _GRAM + 1, dtype="<u8", buffer=np.ascontiguousarray(data), strides=(1,))
            least = least_places(mixed(grams ^ np.uint64(0x9E3779B97F4A7C15)), size - 2 * self.margin)
            at = least[starts + self.margin]
            new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            self.places = at[new]
            self.low = starts[new]
            self.high = starts[np.r_[new[1:], len(at)] - 1]
        self.rows = np.searchsorted(bounds, self.places, "right") - 1
        self.names = Names(BYTE_VALUES[0][data])
        self._checks = None

    @property
    def checks(self) -> Names:
        if self._checks is None:
            self._checks = Names(BYTE_VALUES[1][self.data], 1)
        return self._checks

    def cores(self) -> np.ndarray:
        """48-bit names of the bytes that all windows of a position hold."""
        return self.names.of(self.places - self.margin, self.places + self.margin) >> _KEY_SHIFT

    def blocks(self, which: np.ndarray) -> dict[str, np.ndarray]:
        """Groups of up to 32 neighbouring windows of the positions `which`."""
        places, rows = self.places[which], self.rows[which]
        least, most = places - self.high[which], places - self.low[which]
        first = least // _BLOCK
        many = most // _BLOCK - first + 1
        of = np.repeat(np.arange(len(places)), many)
        block = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        low, high = np.maximum(least[of], block * _BLOCK), np.minimum(most[of], block * _BLOCK + _BLOCK - 1)
        at = places[of]
        start, end = at - high, at - low + self.size
        shape = mixed((low * 65_536 + high).astype(np.uint64) + np.uint64(7))
        core_start = at - block * _BLOCK
        core = self.names.of(core_start, core_start - _BLOCK + 1 + self.size)
        return {
            "row": rows[of],
            "start": start,
            "windows": high - low + 1,
            "end": end,
            "core": mixed(core ^ mixed(block.astype(np.uint64) + np.uint64(3))),
            "hull": mixed(self.names.of(start, end) ^ shape),
            "hull_check": (self.checks.of(start, end) ^ shape) >> np.uint64(32),
        }


def _positions(size: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in slices(batches, "_text"):
            windows = ByteWindows(data, bounds, size)
            if len(windows.places):
                yield pa.RecordBatch.from_arrays(
                    [take_ids(part, windows.rows), longs(windows.cores())], names=["_id", "_core"]
                )

    return run


def _blocks(size: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in slices(batches, "_text"):
            windows = ByteWindows(data, bounds, size)
            which = np.flatnonzero(among(windows.rows, windows.cores(), part.column(2)))
            if len(which):
                b = windows.blocks(which)
                yield pa.RecordBatch.from_arrays(
                    [take_ids(part, b["row"]), longs(b["core"]), longs(b["hull"]), longs(b["hull_check"])],
                    names=["_id", "_core", "_hull", "_check"],
                )

    return run


def _single_windows(size: int):
    """Windows of the blocks a document is asked for, once for each block."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in slices(batches, "_text"):
            windows = ByteWindows(data, bounds, size)
            b = windows.blocks(np.arange(len(windows.places)))
            once = np.flatnonzero(among(b["row"], b["hull"], part.column(2)))
            _, first = np.unique(np.stack([b["row"][once].astype(np.uint64), b["hull"][once]]), axis=1, return_index=True)
            once = once[first]
            if len(once):
                alone = among(b["row"][once], b["hull"][once], part.column(3))
                many = b["windows"][once]
                of = np.repeat(np.arange(len(once)), many)
                start = b["start"][once][of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
                yield pa.RecordBatch.from_arrays(
                    [
                        take_ids(part, b["row"][once][of]),
                        longs(windows.names.of(start, start + size)),
                        longs(windows.checks.of(start, start + size) >> np.uint64(32)),
                        pa.array(alone[of]),
                    ],
                    names=["_id", "_window", "_check", "_alone"],
                )

    return run


def _left(size: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in slices(batches, "_text"):
            n = len(data)
            change = np.zeros(n + 1, dtype=np.int64)
            marked = len(listed(part.column(2))[0]) + len(listed(part.column(3))[0])
            windows = ByteWindows(data, bounds, size) if marked else None
            if marked and len(windows.places):
                b = windows.blocks(np.arange(len(windows.places)))
                whole = among(b["row"], b["hull"], part.column(2))
                np.add.at(change, b["start"][whole], 1)
                np.add.at(change, b["end"][whole], -1)
                some = np.zeros(part.num_rows, dtype=bool)
                some[listed(part.column(3))[0]] = True
                rest = np.flatnonzero(~whole & some[b["row"]])
                many = b["windows"][rest]
                of = np.repeat(np.arange(len(rest)), many)
                start = b["start"][rest][of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
                start = start[among(b["row"][rest][of], windows.names.of(start, start + size), part.column(3))]
                np.add.at(change, start, 1)
                np.add.at(change, start + size, -1)
            gone = np.cumsum(change[:n]) > 0
            sums = np.r_[0, np.cumsum(gone)]
            # A run starts where the byte before is kept or is in another text.
            new = gone.copy()
            new[1:] &= ~gone[:-1]
            inner = bounds[:-1][bounds[:-1] < bounds[1:]]
            new[inner] = gone[inner]
            runs = np.r_[0, np.cumsum(new)]
            removed = sums[bounds[1:]] - sums[bounds[:-1]]
            left = [
                data[s:e].tobytes() if not r else data[s:e][~gone[s:e]].tobytes()
                for s, e, r in zip(bounds[:-1], bounds[1:], removed)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(np.diff(bounds)),
                    pa.array(removed),
                    pa.array(runs[bounds[1:]] - runs[bounds[:-1]]),
                    pa.array(left, pa.binary()),
                ],
                names=["_id", "n_bytes", "n_removed", "n_spans", "_left"],
            )

    return run


def _repeats(docs: DataFrame, size: int) -> DataFrame:
    """`_key, _whole, _single`: per id, names of its blocks that repeat whole and of single windows that repeat."""
    places = cut(docs.mapInArrow(_positions(size), "_id bigint, _core bigint"), "places")
    shared = places.groupBy("_core").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_core")
    wanted = cut(places.join(shared, "_core").groupBy("_id").agg(F.collect_set("_core").alias("_cores")), "wanted")
    blocks = cut(
        with_lists(docs, wanted).mapInArrow(
            _blocks(size), "_id bigint, _core bigint, _hull bigint, _check bigint"
        ),
        "blocks",
    )
    kinds = cut(
        blocks.groupBy("_core", "_hull", "_check").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_id")),
        "kinds",
    )
    mixed_cores = (
        kinds.groupBy("_core")
        .agg(F.count(F.lit(1)).alias("_kinds"), F.min("_n").alias("_least"))
        .where("_kinds > 1 AND _least = 1")
        .select("_core")
    )
    asked = cut(
        kinds.join(mixed_cores, "_core")
        .groupBy("_id")
        .agg(
            F.collect_set("_hull").alias("_hulls"),
            F.collect_set(F.when(F.col("_n") == 1, F.col("_hull"))).alias("_lone"),
        ),
        "asked",
    )
    windows = cut(
        with_lists(docs, asked).mapInArrow(
            _single_windows(size), "_id bigint, _window bigint, _check bigint, _alone boolean"
        ),
        "windows",
    )
    twice = windows.groupBy("_window", "_check").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    single = windows.where("_alone").join(twice, ["_window", "_check"]).select("_id", F.col("_window").alias("_single"))
    whole = blocks.join(kinds.where("_n > 1").drop("_n", "_id"), ["_core", "_hull", "_check"])
    marks = whole.select("_id", F.col("_hull").alias("_whole"), F.lit(None).cast("bigint").alias("_single")).unionByName(
        single.withColumn("_whole", F.lit(None).cast("bigint"))
    )
    return cut(
        marks.groupBy("_id").agg(F.collect_set("_whole").alias("_whole"), F.collect_set("_single").alias("_single")),
        "marks",
    )


def with_lists(docs: DataFrame, lists: DataFrame, how: str = "inner") -> DataFrame:
    """Texts joined to lists by id; null ids meet each other."""
    named = lists.withColumnRenamed("_id", "_key")
    return docs.join(named, docs["_id"].eqNullSafe(named["_key"]), how).drop("_key")


def remove_repeated_bytes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SIZE_BYTES
) -> DataFrame:
    """One row per document: `id, n_bytes, n_removed, n_spans, kept` with the bytes that are left.

    Texts are UTF-8 bytes. A byte goes if a string of `size` bytes covers it that also starts at
    another place, in the same or another row; overlaps count, and strings are judged on the input.
    `n_spans` counts the maximal runs that went.

    Null texts are empty. Texts below `size` bytes stay whole. Repeated rows are copies like any
    other, so both lose what they share; rows that share an id (or have none) are told apart by
    their texts. Other columns are not read. `size` is at least 64.
    """
    if size < 64:
        raise ValueError("size must be at least 64 bytes")
    rows = docs.select(F.col(id_column).cast("bigint").alias("_id"), as_bytes(text_column).alias("_text"))
    done = with_lists(rows, _repeats(rows, size), "left").mapInArrow(
        _left(size), "_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, _left binary"
    )
    return done.select(F.col("_id").alias(id_column), "n_bytes", "n_removed", "n_spans", F.col("_left").alias("kept"))
