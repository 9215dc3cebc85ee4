"""Connected components by joins: edges are rewritten as stars until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to its least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("_least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("_least"))
    moved = edges.join(least, "a").where("b > _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return moved.unionByName(least.select("a", F.col("_least").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("bigint"))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """`a, b` (longs, any order, repeats and loops allowed) to `node, root`, root the least of its component.

    Nodes that are their own root are left out; so an empty table gives an empty one. Each round
    is two joins with pre-aggregated minima; the rounds grow with the logarithm of the size of a
    component, and every round is written to the shared folder, so no lineage builds up.
    """
    stars = cut(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "stars",
    )
    before = _state(stars)
    while before[0]:
        stars = cut(_small_star(_large_star(stars)), "stars")
        after = _state(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
