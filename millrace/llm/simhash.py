"""Near-duplicates by SimHash fingerprints, all pairs compared in tiles.

Equal fingerprints collapse first. The others are dealt into tiles of one population count and
bounded size; two tiles meet if their counts differ by the radius at most, since every differing
bit changes the count by one. Inside a pair of tiles blocks of rows are compared by exclusive-or
and bit counts, blocks whose counts by quarter of the word differ too much are skipped, and a
spanning forest of the links found is returned, never the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import as_bytes, cut, slices, texts
from millrace.llm.components import components

SHINGLE_WORDS = 4
RADIUS = 4
TILE_ROWS = 16_384
_BLOCK = 256


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """SimHash of one text: bits set in over half of the hashes of its shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.zeros(len(words), dtype=np.int64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts[1:] = np.cumsum(sizes + 1)[:-1]
    ends = starts + sizes
    many = max(1, len(words) - size + 1)
    first, last = starts[:many].tolist(), ends[min(size, len(words)) - 1 :].tolist()
    hashing = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, many, 65_536):
        hashes = np.array([hashing(joined[s:e], 42) for s, e in zip(first[at : at + 65_536], last[at : at + 65_536])], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > many).tobytes(), "big")


def _fingerprints(size: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for part, _, _ in slices(batches, "_text"):
            found = np.array([fingerprint(t, size) for t in texts(part.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], names=["_id", "_fp"])

    return run


class _Forest:
    """Labels of linked rows; `link` joins the labels of pairs of rows."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.label[self.label]
                if np.array_equal(up, self.label):
                    break
                self.label = up


def _quarters(prints: np.ndarray) -> np.ndarray:
    return np.stack([np.bitwise_count((prints >> np.uint64(s)) & np.uint64(0xFFFF)) for s in (48, 32, 16, 0)], axis=1)


def linked(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links of two tiles (or within one): fingerprint, a fingerprint of its tree."""
    prints, boxes, spans = [], [], []
    for side, tile in enumerate((left,) if right is None else (left, right)):
        quarters = _quarters(tile)
        order = np.lexsort(quarters.T[::-1])
        tile, quarters = tile[order], quarters[order].astype(np.int16)
        base = sum(map(len, prints))
        for s in range(0, len(tile), _BLOCK):
            part = quarters[s : s + _BLOCK]
            boxes.append((part.min(axis=0), part.max(axis=0)))
            spans.append((side, base + s, base + min(s + _BLOCK, len(tile))))
        prints.append(tile)
    values = np.concatenate(prints)
    forest = _Forest(len(values))
    low, high = np.array([b[0] for b in boxes]), np.array([b[1] for b in boxes])
    other = np.flatnonzero([side == (right is not None) for side, _, _ in spans])
    for i, (side, s, e) in enumerate(spans):
        if side:
            continue
        gap = np.maximum(0, np.maximum(low[other] - high[i], low[i] - high[other])).sum(axis=1)
        for j in other[gap <= radius]:
            if right is None and j < i:
                continue
            a, b = np.nonzero(np.bitwise_count(values[s:e, None] ^ values[None, spans[j][1] : spans[j][2]]) <= radius)
            if len(a):
                forest.link(a + s, b + spans[j][1])
    moved = np.flatnonzero(forest.label != np.arange(len(values)))
    return values[moved], values[forest.label[moved]]


def _pairs_of_tiles(radius: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        prints = group["_fp"].to_numpy(np.int64).view(np.uint64)
        first = group["_side"].to_numpy() == 0
        one = group["_p"].iloc[0] == group["_q"].iloc[0] and group["_c"].iloc[0] == group["_d"].iloc[0]
        a, b = linked(prints[first], None if one else prints[~first], radius) if first.any() else ([], [])
        return pd.DataFrame({"a": np.array(a, np.uint64).view(np.int64), "b": np.array(b, np.uint64).view(np.int64)})

    return run


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """`a, b`: links that connect every two of the distinct longs `_fp` with at most `radius` differing bits."""
    counted = prints.select("_fp", F.bit_count("_fp").alias("_p"))
    tiles = {p: -(-n // tile_rows) for p, n in counted.groupBy("_p").count().collect()}  # 65 rows at most
    chunks = F.element_at(F.lit([tiles.get(p, 0) for p in range(65)]), F.col("_q") + 1)
    here = F.element_at(F.lit([max(1, tiles.get(p, 0)) for p in range(65)]), F.col("_p") + 1)
    reached = (
        counted.withColumn("_c", F.pmod(F.xxhash64("_fp"), here).cast("int"))
        .withColumn(
            "_q",
            F.explode(F.sequence(F.greatest(F.lit(0), F.col("_p") - radius), F.least(F.lit(64), F.col("_p") + radius))),
        )
        .where(chunks > 0)
        .withColumn("_d", F.explode(F.sequence(F.lit(0), (chunks - 1).cast("int"))))
    )
    mine, theirs = F.struct("_p", "_c"), F.struct(F.col("_q").alias("_p"), F.col("_d").alias("_c"))
    paired = reached.select(
        "_fp",
        F.when(mine <= theirs, 0).otherwise(1).alias("_side"),
        F.least(mine, theirs).alias("_x"),
        F.greatest(mine, theirs).alias("_y"),
    ).select(
        "_fp",
        "_side",
        F.col("_x._p").alias("_p"),
        F.col("_x._c").alias("_c"),
        F.col("_y._p").alias("_q"),
        F.col("_y._c").alias("_d"),
    )
    return paired.groupBy("_p", "_c", "_q", "_d").applyInPandas(_pairs_of_tiles(radius), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """One row per document: `id, fingerprint, component_id` (the smallest id reachable by links).

    A-Z are lowered; words are `[^\\x20\\x09-\\x0D]+`; a shingle is `size` words joined by a space, all
    words where there are fewer; repeats count. A bit of the fingerprint is set if it is set in over
    half of the XXH64 hashes (seed 42). Two documents are linked if their fingerprints differ in at
    most `radius` bits; no link is lost, however large a group of copies is.

    Texts without words (null, empty, blank) have fingerprint zero and link like any other. Rows
    with a null id take part and never name a component unless all of it lacks ids (then null).
    Repeated rows are copies. Other columns are not read.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("_id"), as_bytes(text_column).alias("_text"))
    marked = cut(rows.mapInArrow(_fingerprints(size), "_id bigint, _fp bigint"), "fingerprints")
    prints = cut(marked.groupBy("_fp").agg(F.min("_id").alias("_least")), "prints")
    roots = components(fingerprint_links(prints.select("_fp"), radius, tile_rows))
    rooted = prints.join(roots.withColumnRenamed("node", "_fp"), "_fp", "left").select(
        "_fp", F.coalesce("root", "_fp").alias("_root"), "_least"
    )
    named = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    names = rooted.join(named, "_root").select("_fp", "component_id")
    return marked.join(names, "_fp").select(
        F.col("_id").alias(id_column), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id"
    )
