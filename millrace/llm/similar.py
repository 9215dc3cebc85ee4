"""Groups of similar documents: wide SimHash tiles give candidates, exact shingle sets decide.

A text is the set of its shingles. Equal sets are one node. At a similarity of 0.8 some 15 % of the
bits of two fingerprints differ, so fingerprints have 256 bits and a wide radius: the first 64 are
compared in tiles by exclusive-or and bit counts, the others only where those are near. Tiles
are ranges of set sizes, since sets that are similar enough differ little in size. Every candidate is
then verified on the shingles themselves in a join, and only verified pairs form components.

A tile pair with few candidates gives all of them. One with many, as a large group of near copies
has, first gives its forest of nearest candidates; once these are verified and joined, it is read
again, with its shingles, for what links different components. There a row only meets rows near its
fingerprint that share one of its rarest shingles: two sets of this similarity always do (prefix filter, by
the counts in the tiles). Their common shingles are counted, and a link is given only if it joins two
components, so a tile pair gives fewer links than it has rows, however many pairs are near.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import as_bytes, cut, mixed, slices, texts
from millrace.llm.components import components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
WORDS = 4
FIRST_RADIUS = 22  # of 64 bits; about 10 differ at 0.8, 32 by chance
RADIUS = 80  # of 256 bits; about 39 differ at 0.8, 128 by chance
TILE_ROWS = 4096
_BLOCK = 512
_FINE = 8
_SALT_ROWS = 256
_DENSE = 8
_KEEP_EDGES = 1 << 18
_TILE_SHINGLES = 1 << 20
_PRINTS = [f"_f{k}" for k in range(WORDS)]
_TILE = ["_p", "_c", "_q", "_d"]
_PAIR_SCHEMA = "_a bigint, _b bigint, _sa int, _sb int, _p int, _c int, _q int, _d int, _all boolean"


def shingles(text: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; none for a text without words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.zeros(len(words), dtype=np.int64)
    starts[1:] = np.cumsum(sizes + 1)[:-1]
    many = max(1, len(words) - size + 1)
    first, last = starts[:many].tolist(), (starts + sizes)[min(size, len(words)) - 1 :].tolist()
    hashing = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((hashing(joined[s:e], 42) for s, e in zip(first, last)), dtype=np.uint64, count=many))


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """SimHash of a set in `WORDS` words of 64 bits."""
    counts = np.zeros((WORDS, 64), dtype=np.int64)
    for at in range(0, len(hashes), 16_384):
        part = hashes[at : at + 16_384]
        for k in range(WORDS):
            spread = mixed(part + np.uint64(k)) if k else part
            counts[k] += np.unpackbits(spread.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes), axis=1).view(">u8").ravel().astype(np.uint64)


def _read(size: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for part, _, _ in slices(batches, "_text"):
            sets = [shingles(t, size) for t in texts(part.column(1))]
            prints = np.array([fingerprint(s) for s in sets], dtype=np.uint64).view(np.int64)
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), 7) for s in sets], dtype=np.uint64).view(np.int64)
            sizes = np.fromiter(map(len, sets), dtype=np.int32, count=len(sets))
            bounds = np.r_[0, np.cumsum(sizes)].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(row + np.arange(len(sets), dtype=np.int64)),
                    pa.array(nodes),
                    pa.array(sizes),
                    *(pa.array(prints[:, k]) for k in range(WORDS)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(sets).view(np.int64))),
                ],
                names=["_id", "_row", "_node", "_size", *_PRINTS, "_set"],
            )
            row += len(sets)

    return run


def _forest(a: np.ndarray, b: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Which of the edges form the forest of least distances (Boruvka's rounds)."""
    nodes, ends = np.unique(np.r_[a, b], return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    rank = np.empty(len(a), dtype=np.int64)
    rank[np.lexsort((b, a, far))] = np.arange(len(a))
    by_rank = np.argsort(rank)
    label, taken = np.arange(len(nodes)), np.zeros(len(a), dtype=bool)
    while True:
        apart = np.flatnonzero(label[x] != label[y])
        if not len(apart):
            return taken
        best = np.full(len(nodes), len(a), dtype=np.int64)
        np.minimum.at(best, label[x[apart]], rank[apart])
        np.minimum.at(best, label[y[apart]], rank[apart])
        new = by_rank[np.unique(best[best < len(a)])]
        taken[new] = True
        u, v = label[x[new]], label[y[new]]
        while True:
            p, q = label[u], label[v]
            if np.array_equal(p, q):
                break
            np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
            while not np.array_equal(label, label[label]):
                label = label[label]


def _occurrences(values: np.ndarray) -> np.ndarray:
    """How often each value stood before."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(values) else np.empty(0, np.int64)
    found = np.empty(len(values), dtype=np.int64)
    found[order] = np.arange(len(values)) - np.repeat(starts, np.diff(np.r_[starts, len(values)]))
    return found


def candidates(
    nodes: np.ndarray, sizes: np.ndarray, prints: np.ndarray, labels: np.ndarray, left: np.ndarray, similarity: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Near pairs of rows (of `left` and the others; all rows if none are others), and their distances."""
    order = np.lexsort((nodes, sizes))
    mine, theirs = order[left[order]], order[~left[order]]
    one = not len(theirs)
    theirs = mine if one else theirs
    for s in range(0, len(mine), _BLOCK):
        i = mine[s : s + _BLOCK]
        # Sorted by size: rows too small or too large for all of this block are not compared.
        low = int(np.searchsorted(sizes[theirs], sizes[i[0]] * similarity * (1 - 1e-9), "left"))
        high = int(np.searchsorted(sizes[theirs], sizes[i[-1]] / similarity * (1 + 1e-9), "right"))
        for t in range(max(low, s) if one else low, high, _BLOCK):
            j = theirs[t : min(t + _BLOCK, high)]
            x, y = np.nonzero(np.bitwise_count(prints[i, 0][:, None] ^ prints[j, 0][None, :]) <= FIRST_RADIUS)
            x, y = i[x], j[y]
            some = nodes[x] < nodes[y] if one and t < s + _BLOCK else nodes[x] != nodes[y]
            some &= labels[x] != labels[y]
            x, y = x[some], y[some]
            far = np.bitwise_count(prints[x] ^ prints[y]).sum(axis=1, dtype=np.int64)
            near = far <= RADIUS
            if near.any():
                yield x[near], y[near], far[near]


def _columns(group: pd.DataFrame) -> tuple[np.ndarray, ...]:
    nodes, sizes, labels = (group[c].to_numpy(np.int64) for c in ("_node", "_size", "_label"))
    prints = np.stack([group[c].to_numpy(np.int64).view(np.uint64) for c in _PRINTS], axis=1)
    return nodes, sizes, prints, labels, group["_side"].to_numpy() == 0


def _pairs_of_tiles(similarity: float):
    dense = _DENSE

    def run(group: pd.DataFrame) -> pd.DataFrame:
        nodes, sizes, prints, labels, left = _columns(group)
        tile = [int(group[c].iloc[0]) for c in _TILE]
        a, b, far = (np.empty(0, np.int64) for _ in range(3))
        whole, waiting, held = True, [], 0
        if left.any() and (tile[:2] == tile[2:] or not left.all()):
            for found in candidates(nodes, sizes, prints, labels, left, similarity):
                waiting.append(found)
                held += len(found[0])
                if held > max(_KEEP_EDGES, dense * len(group)):
                    a, b, far = (np.concatenate([w[k] for w in waiting]) for k in range(3))
                    keep = _forest(a, b, far)
                    waiting, held, whole = [(a[keep], b[keep], far[keep])], int(keep.sum()), False
            if waiting:
                a, b, far = (np.concatenate([w[k] for w in waiting]) for k in range(3))
                if not whole or len(a) > dense * len(group):
                    keep = _forest(a, b, far)
                    a, b, whole = a[keep], b[keep], False
        a, b = nodes[a], nodes[b]
        made = {"_a": a, "_b": b, "_sa": _occurrences(a) // _SALT_ROWS, "_sb": _occurrences(b) // _SALT_ROWS}
        return pd.DataFrame(made | dict(zip(_TILE, tile)) | {"_all": whole})

    return run


def joining_links(
    nodes: np.ndarray, sizes: np.ndarray, prints: np.ndarray, labels: np.ndarray, left: np.ndarray, sets: list[np.ndarray], similarity: float
) -> list[tuple[int, int]]:
    """Similar pairs of rows, each joining two components (labels) that no earlier pair of the list joins.

    Exact for the pairs within `RADIUS`: rows of that similarity share one of their rarest shingles, and what
    they share is counted.
    """
    n = len(nodes)
    labels = labels.copy()
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    many = np.bincount(token)
    # Rows of each shingle; and the shingles of each row, rare ones first.
    by_token = np.argsort(token, kind="stable")
    holders, start = row[by_token], np.r_[0, np.cumsum(many)]
    rare = token[np.lexsort((token, many[token], row))]
    ends = np.cumsum(sizes)
    prefix = sizes - np.ceil(sizes * similarity * (1 - 1e-9)).astype(np.int64) + 1
    one = bool(left.all())
    in_prefix = np.arange(len(rare)) - np.repeat(ends - sizes, sizes) < np.repeat(prefix, sizes)
    first, rows_of = rare[in_prefix], row[in_prefix]
    order = np.argsort(first, kind="stable")
    first, rows_of = first[order], rows_of[order]
    found = []
    for a in np.flatnonzero(left).tolist():
        mine = rare[ends[a] - sizes[a] : ends[a]]
        own = mine[: prefix[a]]
        own = own[many[own] > 1]
        if not len(own):
            continue
        low, high = np.searchsorted(first, own, "left"), np.searchsorted(first, own, "right")
        near = np.zeros(n, dtype=bool)
        for x, y in zip(low.tolist(), high.tolist()):
            near[rows_of[x:y]] = True
        near &= labels != labels[a]
        if not one:
            near &= ~left
        near &= (sizes >= sizes[a] * similarity * (1 - 1e-9)) & (sizes * similarity * (1 - 1e-9) <= sizes[a])
        others = np.flatnonzero(near)
        others = others[np.bitwise_count(prints[others] ^ prints[a]).sum(axis=1, dtype=np.int64) <= RADIUS]
        if not len(others):
            continue
        common = np.zeros(n, dtype=np.int64)
        for t in mine[many[mine] > 1].tolist():
            common[holders[start[t] : start[t + 1]]] += 1
        shared = common[others]
        for b in others[shared / (sizes[a] + sizes[others] - shared) >= similarity].tolist():
            if labels[a] != labels[b]:
                found.append((a, b))
                labels[labels == labels[b]] = labels[a]
    return found


def _links_of_tiles(similarity: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        nodes, sizes, prints, labels, left = _columns(group)
        found = []
        if left.any():
            sets = [np.asarray(s, dtype=np.int64) for s in group["_set"]]
            found = joining_links(nodes, sizes, prints, labels, left, sets, similarity)
        ends = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": nodes[ends[:, 0]], "b": nodes[ends[:, 1]]})

    return run


def _tiled(nodes: DataFrame, similarity: float, tile_rows: int) -> DataFrame:
    """Rows of `nodes` once for each pair of tiles they are in, `_side` 0 for the lower tile."""
    step = -math.log(similarity) / _FINE
    reach = _FINE + 1
    counted = nodes.where("_size > 0").withColumn("_p", F.floor(F.log("_size") / step).cast("int"))
    # One row per range of sizes, some hundreds at most. A tile has a bounded number of shingles, too.
    tiles = {
        r["_p"]: -(-r["count"] // max(1, min(tile_rows, int(_TILE_SHINGLES / math.exp((r["_p"] + 1) * step)))))
        for r in counted.groupBy("_p").count().collect()
    }
    top = max(tiles, default=0)
    # Places from -reach to top + reach, so that no neighbour lies outside.
    many = F.lit([tiles.get(p, 0) for p in range(-reach, top + reach + 1)])
    placed = counted.withColumn("_c", F.pmod(F.xxhash64("_node"), F.greatest(F.lit(1), F.element_at(many, F.col("_p") + reach + 1))).cast("int"))
    met = (
        placed.withColumn("_q", F.explode(F.sequence(F.col("_p") - reach, F.col("_p") + reach)))
        .withColumn("_chunks", F.element_at(many, F.col("_q") + reach + 1).cast("int"))
        .where("_chunks > 0")
        .withColumn("_d", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    )
    mine, theirs = F.struct("_p", "_c"), F.struct(F.col("_q").alias("_p"), F.col("_d").alias("_c"))
    return met.withColumns(
        {"_side": F.when(mine <= theirs, 0).otherwise(1), "_x": F.least(mine, theirs), "_y": F.greatest(mine, theirs)}
    ).select(
        "_node", "_size", *_PRINTS, "_label", "_side",
        F.col("_x._p").alias("_p"), F.col("_x._c").alias("_c"), F.col("_y._p").alias("_q"), F.col("_y._c").alias("_d"),
    )


def verified(pairs: DataFrame, nodes: DataFrame, read: DataFrame, similarity: float) -> DataFrame:
    """`a, b`: the pairs whose shingle sets have at least the similarity. Nodes in many pairs are salted."""
    wanted = (
        pairs.select(F.col("_a").alias("_node"), F.col("_sa").alias("_salt"))
        .unionByName(pairs.select(F.col("_b").alias("_node"), F.col("_sb").alias("_salt")))
        .distinct()
    )
    rows = wanted.join(nodes.select("_node", "_row"), "_node")
    sets = cut(rows.join(read.select("_row", "_set"), "_row").select("_node", "_salt", "_set"), "sets")
    first = sets.select(F.col("_node").alias("_a"), F.col("_salt").alias("_sa"), F.col("_set").alias("_left"))
    second = sets.select(F.col("_node").alias("_b"), F.col("_salt").alias("_sb"), F.col("_set").alias("_right"))
    both = pairs.select("_a", "_b", "_sa", "_sb").join(first, ["_a", "_sa"]).join(second, ["_b", "_sb"])
    common = F.size(F.array_intersect("_left", "_right"))
    every = F.size("_left") + F.size("_right") - common
    return both.where(common / every >= similarity).select(F.col("_a").alias("a"), F.col("_b").alias("b"))


def similar_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """One row per document: `id, component_id` (the smallest id reachable by similar pairs).

    Words and shingles are those of `simhash.near_duplicates`, but each shingle counts once. Two
    documents are similar if the shared part of all their shingles is at least `similarity`.
    Texts without words are copies of each other and similar to nothing else.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("_id"), as_bytes(text_column).alias("_text"))
    schema = f"_id bigint, _row bigint, _node bigint, _size int, {', '.join(f'{c} bigint' for c in _PRINTS)}, _set array<bigint>"
    read = cut(rows.mapInArrow(_read(size), schema), "shingles")
    least = F.min(F.struct("_id", "_row", "_size", *_PRINTS)).alias("_least")
    nodes = cut(read.groupBy("_node").agg(least).select("_node", "_least.*"), "nodes")
    start = nodes.withColumn("_label", F.col("_node"))
    found = _tiled(start, similarity, tile_rows).groupBy(*_TILE).applyInPandas(_pairs_of_tiles(similarity), _PAIR_SCHEMA)
    found = cut(found, "candidates")
    links = cut(verified(found, nodes, read, similarity), "links")
    roots = components(links)
    dense = found.where("NOT _all").select(*_TILE).distinct()
    if not dense.isEmpty():
        labelled = nodes.join(roots.withColumnRenamed("node", "_node"), "_node", "left").withColumn(
            "_label", F.coalesce("root", "_node")
        )
        again = _tiled(labelled, similarity, tile_rows).join(dense, _TILE, "left_semi")
        sets = nodes.select("_node", "_row").join(read.select("_row", "_set"), "_row").select("_node", "_set")
        met = again.join(sets, "_node")
        more = cut(met.groupBy(*_TILE).applyInPandas(_links_of_tiles(similarity), "a bigint, b bigint"), "links")
        roots = components(links.unionByName(more))
    rooted = nodes.join(roots.withColumnRenamed("node", "_node"), "_node", "left").select(
        "_node", F.coalesce("root", "_node").alias("_root"), "_id"
    )
    named = rooted.groupBy("_root").agg(F.min("_id").alias("component_id"))
    names = rooted.join(named, "_root").select("_node", "component_id")
    return read.join(names, "_node").select(F.col("_id").alias(id_column), "component_id")
