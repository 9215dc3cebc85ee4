"""Removal of word spans that an earlier document holds: a De Bruijn graph of word windows.

An edge is a window of `size` words (its ends are the nodes of size - 1 words). Edges are compacted
to paths: neighbouring edges that share their least middle word form one unbranched stretch, and
one row stands for all of it. Spark joins decide paths first: those whose core (the words around
the least one, which all edges of the path hold) lies in one document are unique; a path that an
earlier document holds whole goes whole. Only where paths branch, that is where one core lies in
different paths, the first copy of each is unfolded into edges, which are joined to find the
smallest document that holds each. The texts themselves (the coordinates) settle which words the
paths and edges of a document cover. Nothing is sampled: a window always holds its core.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import BYTE_VALUES, Names, as_bytes, cut, least_places, mixed, slices, texts, word_bounds

WINDOW_WORDS = 13
_MARGIN = 2
_KEY_SHIFT = np.uint64(16)


class WordWindows:
    """All windows of one slice: row, first word, name (96 bits) and name of the middle of the path."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, size: int):
        starts, ends, self.rows = word_bounds(data, bounds)
        self.size = size
        words = Names(BYTE_VALUES[0][data]).of(starts, ends)
        self.names, self.checks = Names(words), Names(words, 1)
        last = len(words) - size
        first = np.arange(max(0, last + 1))
        self.first = first[self.rows[: len(first)] == self.rows[size - 1 :][: len(first)]]
        margin = min(_MARGIN, (size - 1) // 2)
        least = np.empty(0, np.int64)
        if len(self.first):
            least = least_places(mixed(words), size - 2 * margin)[self.first + margin]
        row = self.rows[self.first]
        # Paths: neighbouring windows of a row with the same least middle word.
        new = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (row[1:] != row[:-1])][: len(least)])
        self.path_rows = row[new]
        self.path_first = self.first[new]
        self.path_size = np.diff(np.r_[new, len(least)])
        self.cores = self.names.of(least[new] - margin, least[new] + margin + 1) >> _KEY_SHIFT

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """Names of all words that the windows of each path cover."""
        start, end = self.path_first, self.path_first + self.path_size + self.size - 1
        return self.names.of(start, end), self.checks.of(start, end) >> np.uint64(32)

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Path and first word of the windows of the paths `which`."""
        of = np.repeat(which, self.path_size[which])
        many = self.path_size[which]
        return of, self.path_first[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)

    def edges(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.names.of(at, at + self.size), self.checks.of(at, at + self.size) >> np.uint64(32)


def _in_row(rows: np.ndarray, names: np.ndarray) -> np.ndarray:
    return mixed(names ^ mixed(rows.astype(np.uint64) + np.uint64(1)))


def listed(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every entry of a list column of longs."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(values), 0))
    flat = np.asarray(pc.fill_null(pc.drop_null(values).flatten(), 0), dtype=np.int64).view(np.uint64)
    return np.repeat(np.arange(len(sizes)), sizes), flat


def among(rows: np.ndarray, names: np.ndarray, values: pa.Array) -> np.ndarray:
    """Whether each (row, name) is in the list of its row."""
    of, flat = listed(values)
    return np.isin(_in_row(rows, names), _in_row(of, flat))


def take_ids(batch: pa.RecordBatch, rows: np.ndarray) -> pa.Array:
    return batch.column(0).take(pa.array(rows))


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64))


def _cores(size: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in slices(batches, "_text"):
            windows = WordWindows(data, bounds, size)
            if len(windows.cores):
                yield pa.RecordBatch.from_arrays(
                    [take_ids(part, windows.path_rows), longs(windows.cores)], names=["_id", "_core"]
                )

    return run


def _paths(size: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in slices(batches, "_text"):
            windows = WordWindows(data, bounds, size)
            some = np.flatnonzero(among(windows.path_rows, windows.cores, part.column(2)))
            if len(some):
                names, checks = windows.paths()
                yield pa.RecordBatch.from_arrays(
                    [take_ids(part, windows.path_rows[some]), longs(windows.cores[some]), longs(names[some]), longs(checks[some])],
                    names=["_id", "_core", "_path", "_check"],
                )

    return run


def _edges(size: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in slices(batches, "_text"):
            windows = WordWindows(data, bounds, size)
            some = np.flatnonzero(among(windows.path_rows, windows.paths()[0], part.column(2)))
            of, at = windows.windows(some)
            if len(of):
                names, checks = windows.edges(at)
                yield pa.RecordBatch.from_arrays(
                    [take_ids(part, windows.path_rows[of]), longs(names), longs(checks)], names=["_id", "_edge", "_check"]
                )

    return run


def _removed(size: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in slices(batches, "_text"):
            windows = WordWindows(data, bounds, size)
            n = len(windows.rows)
            change = np.zeros(n + 1, dtype=np.int64)
            whole = among(windows.path_rows, windows.paths()[0], part.column(2))
            _, hit = windows.windows(np.flatnonzero(whole))
            single = np.isin(windows.path_rows, listed(part.column(3))[0]) & ~whole
            of, at = windows.windows(np.flatnonzero(single))
            hit = np.r_[hit, at[among(windows.path_rows[of], windows.edges(at)[0], part.column(3))]]
            np.add.at(change, hit, 1)
            np.add.at(change, hit + size, -1)
            kept = np.cumsum(change[:-1]) == 0
            counts = np.bincount(windows.rows, minlength=part.num_rows)
            removed = np.bincount(windows.rows[~kept], minlength=part.num_rows)
            at = np.r_[0, np.cumsum(counts)]
            left = []
            for row, text in enumerate(texts(part.column(1))):
                words = text.split()
                left.append(b" ".join(compress(words, kept[at[row] : at[row + 1]]) if removed[row] else words))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts), pa.array(removed), pa.array(left, pa.binary())],
                names=["_id", "n_words", "n_removed", "_left"],
            )

    return run


def repeated_windows(docs: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """`_id, _whole, _single`: names of the paths and of the single windows of an id that a smaller id holds."""
    cores = cut(docs.mapInArrow(_cores(size), "_id bigint, _core bigint"), "cores")
    shared = cores.groupBy("_core").agg(F.min("_id").alias("_low"), F.max("_id").alias("_high")).where("_low < _high")
    wanted = cores.join(shared.select("_core"), "_core").groupBy("_id").agg(F.collect_set("_core").alias("_cores"))
    paths = cut(
        docs.join(cut(wanted, "wanted"), "_id").mapInArrow(
            _paths(size), "_id bigint, _core bigint, _path bigint, _check bigint"
        ),
        "paths",
    )
    key = ["_core", "_path", "_check"]
    kinds = cut(paths.groupBy(*key).agg(F.min("_id").alias("_low")), "kinds")
    # Where all copies of a core lie in one kind of path its first copy has nothing earlier.
    branched = kinds.groupBy("_core").count().where("count > 1").select("_core")
    asked = kinds.join(branched, "_core").groupBy(F.col("_low").alias("_id")).agg(F.collect_set("_path").alias("_asked"))
    edges = cut(
        docs.join(cut(asked, "asked"), "_id").mapInArrow(_edges(size), "_id bigint, _edge bigint, _check bigint"),
        "edges",
    )
    low = edges.groupBy("_edge", "_check").agg(F.min("_id").alias("_low"), F.max("_id").alias("_high"))
    single = edges.join(low.where("_low < _high"), ["_edge", "_check"]).where("_id > _low").select(
        "_id", F.lit(None).cast("bigint").alias("_whole"), F.col("_edge").alias("_single")
    )
    whole = paths.join(kinds, key).where("_id > _low").select(
        "_id", F.col("_path").alias("_whole"), F.lit(None).cast("bigint").alias("_single")
    )
    marks = whole.unionByName(single).groupBy("_id")
    return cut(marks.agg(F.collect_set("_whole").alias("_whole"), F.collect_set("_single").alias("_single")), "marks")


def remove_repeated_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = WINDOW_WORDS
) -> DataFrame:
    """One row per document: `id, n_words, n_removed, kept` with the words that are left.

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A word goes if a window of `size` words of its
    document covers it whose sequence also starts in a document with a smaller id; windows are
    judged on the input. `kept` holds the other words joined by one space, as UTF-8 bytes.

    Null, empty and blank texts have no words and stay empty; texts below `size` words stay whole.
    Repeated ids: a window counts as held by its id once, so equal rows with one id keep their
    words alike. A row with a null id has no order: it is returned whole and removes nothing
    elsewhere. Other columns are not read. Very long texts are one slice of their own.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("_id"), as_bytes(text_column).alias("_text"))
    marks = repeated_windows(rows.where("_id IS NOT NULL"), size)
    done = rows.join(marks, "_id", "left").mapInArrow(
        _removed(size), "_id bigint, n_words bigint, n_removed bigint, _left binary"
    )
    return done.select(F.col("_id").alias(id_column), "n_words", "n_removed", F.col("_left").alias("kept"))
