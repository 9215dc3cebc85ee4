"""Exact top-k by inner product: vectors grouped by length, pruned by local thresholds, then verified.

Candidates are sorted into buckets of similar length. A first pass takes the scores of each query
with the longest vectors only; its k-th best is a floor that no result can be under. A bucket
whose longest vector cannot reach the floor of a query never sees it. In the buckets that are left
the floor turns into a local cosine threshold t = floor / (|q| * l), l the longest length there:
where t is high, a coordinate test keeps candidates whose value in the query's strongest
coordinates lies in the range that a cosine of at least t allows; where it is low, candidates are
cut by length alone. What remains is verified by exact integer products.

Queries are dealt into blocks by hash, so that one group holds a bucket and a block, both bounded,
however many queries reach the bucket. The partial results of a query are merged.
"""

from __future__ import annotations



import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import cut

TOP = 5
QUERY_EVERY = 50
SCALE = 256
BUCKET_ROWS = 1024
QUERY_BLOCK = 256
QUERY_ROWS = 4096
_CLASSES_PER_DOUBLING = 4
_COORDINATES = 3
_COSINE = 0.6


def usable(vector: Column) -> Column:
    """Neither null nor holding null, NaN or infinite components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.int64) for v in column], dtype=np.int64).reshape(len(column), -1)


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products; by floats where they are exact, since those are faster."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, queries.shape[1])
    if most < 2**53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


class _Best:
    """The k best (score, id) per query so far, ties to the smaller id; `floor` is the k-th score."""

    def __init__(self, ids: np.ndarray, floors: np.ndarray, k: int):
        self.ids, self.k, self.floors = ids, k, floors
        self.rows: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(ids)

    def offer(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        own = (ids != self.ids[q]) & (scores >= self.floors[q])
        if not own.any():
            return
        s, i = np.r_[self.rows[q][0], scores[own]], np.r_[self.rows[q][1], ids[own]]
        best = np.lexsort((i, -s))[: self.k]
        self.rows[q] = (s[best], i[best])
        if len(best) == self.k:
            self.floors[q] = max(self.floors[q], s[best][-1])

    def frame(self) -> pd.DataFrame:
        many = [len(s) for s, _ in self.rows]
        return pd.DataFrame(
            {
                "_q": np.repeat(self.ids, many),
                "_id": np.concatenate([i for _, i in self.rows]) if many else np.empty(0, np.int64),
                "_score": np.concatenate([s for s, _ in self.rows]) if many else np.empty(0, np.int64),
            }
        )


def _feasible(q: np.ndarray, t: float, units: np.ndarray) -> np.ndarray:
    """Candidates whose strongest coordinates admit a cosine of at least t with the unit vector q."""
    keep = np.ones(len(units), dtype=bool)
    for f in np.argsort(-np.abs(q))[:_COORDINATES]:
        x = float(q[f])
        spread = np.sqrt(max(0.0, 1 - t * t)) * np.sqrt(max(0.0, 1 - x * x)) + 1e-9
        low = t * x - spread if -x < t else -1.0
        high = t * x + spread if x < t else 1.0
        keep &= (units[:, f] >= low - 1e-9) & (units[:, f] <= high + 1e-9)
    return keep


def search_bucket(
    query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> pd.DataFrame:
    """Best k of one bucket for each query, with pruning by the floors."""
    best = _Best(query_ids, floors.copy(), k)
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    ids, vectors, lengths = ids[order], vectors[order], lengths[order]
    units = vectors / np.maximum(lengths, 1e-300)[:, None]
    own = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    longest = lengths[0] if len(lengths) else 0.0
    simple = []
    for q in range(len(query_ids)):
        reach = own[q] * longest
        t = floors[q] / reach if reach else 0.0
        if floors[q] > 0 and t > 1 + 1e-9:
            continue
        if t < _COSINE:
            simple.append(q)
            continue
        some = np.flatnonzero(_feasible(queries[q] / own[q], min(1.0, t), units))
        if len(some):
            best.offer(q, _products(queries[q : q + 1], vectors[some])[0], ids[some])
    for s in range(0, len(vectors), 2048):
        # Length pruning: the rest is too short for a query once |q| * l is under its floor.
        live = [q for q in simple if best.floors[q] <= own[q] * lengths[s] * (1 + 1e-9)]
        if not live:
            break
        scores = _products(queries[live], vectors[s : s + 2048])
        for row, q in enumerate(live):
            best.offer(q, scores[row], ids[s : s + 2048])
    return best.frame()


def _search(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"_q": [], "_id": [], "_score": []}).astype("int64")
        ids, vectors = left["_id"].to_numpy(np.int64), _matrix(left["_v"])
        parts = []
        for s in range(0, len(right), QUERY_BLOCK):
            block = right.iloc[s : s + QUERY_BLOCK]
            parts.append(
                search_bucket(
                    block["_q"].to_numpy(np.int64), _matrix(block["_w"]), block["_floor"].to_numpy(np.int64), ids, vectors, k
                )
            )
        return pd.concat(parts)

    return run


def _best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best of the partial results of each query (at most k per bucket)."""
    ranked = found.groupBy("_q").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("_score")).alias("_s"), "_id"))), 1, k).alias("_best")
    )
    return ranked.select("_q", F.posexplode("_best").alias("_rank", "_r")).select(
        "_q", F.col("_rank").alias("_rank"), F.col("_r._id").alias("_id"), (-F.col("_r._s")).alias("_score")
    )


def top_inner_products(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    is_query: Column | None = None,
    k: int = TOP,
    scale: int = SCALE,
    bucket_rows: int = BUCKET_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: the k largest integer inner products of each query with all other rows.

    Components become floor(scale * x), x as double. `is_query` is a condition on `id_column`
    (default: divisible by 50). Ties go to the smaller id; fewer rows than k give all of them.

    Vectors that are null or hold null or non-finite components, and rows without an id, take no
    part. An id names one vector: of rows with the same id the least vector counts. Vectors of
    different dimension are never compared. Products must fit into 64 bits. Empty vectors score 0.
    Other columns are not read; an empty table gives an empty result.
    """
    is_query = F.col("_id") % QUERY_EVERY == 0 if is_query is None else is_query
    rows = (
        vectors.select(F.col(id_column).cast("bigint").alias("_id"), F.col(vector_column).alias("_x"))
        .where(usable(F.col("_x")) & F.col("_id").isNotNull())
        .select("_id", F.transform("_x", lambda x: F.floor(scale * x.cast("double"))).alias("_v"))
        .groupBy("_id")
        .agg(F.min("_v").alias("_v"))
    )
    square = F.aggregate("_v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    rows = cut(
        rows.withColumn("_dim", F.size("_v"))
        .withColumn("_len", F.sqrt(square))
        .withColumn(
            "_class",
            F.when(F.col("_len") > 0, F.floor(_CLASSES_PER_DOUBLING * F.log2("_len"))).otherwise(-1).cast("int"),
        ),
        "vectors",
    )
    sizes = rows.groupBy("_dim", "_class").agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_len").alias("_longest")
    )
    parts = sizes.withColumn("_parts", F.ceil(F.col("_rows") / bucket_rows).cast("int"))
    placed = rows.join(parts.select("_dim", "_class", "_parts"), ["_dim", "_class"]).withColumn(
        "_part", F.pmod(F.xxhash64("_id"), F.col("_parts")).cast("int")
    )
    buckets = placed.select("_dim", "_class", "_part", "_id", "_v")
    queries = rows.where(is_query).select(F.col("_id").alias("_q"), "_v", "_dim", "_len")
    blocks = queries.groupBy("_dim").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("_blocks"))
    queries = (
        queries.join(blocks, "_dim")
        .withColumn("_block", F.pmod(F.xxhash64("_q", F.lit("block")), F.col("_blocks")).cast("int"))
        .drop("_blocks")
    )
    key = ["_dim", "_class", "_part"]
    met = [*key, "_block"]
    other = [F.col(c).alias(f"{c}_of") for c in key]
    theirs = [*(f"{c}_of" for c in key), "_block"]
    schema = "_q bigint, _id bigint, _score bigint"

    # First pass: part 0 of the longest class of a dimension with more than k vectors.
    first = (
        parts.where(F.col("_rows") > F.col("_parts") * 2 * k)
        .groupBy("_dim")
        .agg(F.max("_class").alias("_class"))
        .withColumn("_part", F.lit(0))
    )
    none = F.lit(-(2**63) + 1)
    asked = queries.join(first, "_dim").select(*other, "_block", "_q", F.col("_v").alias("_w"), none.alias("_floor"))
    tried = (
        buckets.join(first.join(blocks, "_dim"), key)
        .withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .select(*met, "_id", "_v")
        .groupBy(*met)
        .cogroup(asked.groupBy(*theirs))
        .applyInPandas(_search(k), schema)
    )
    floors = _best_of(tried, k).where(F.col("_rank") == k - 1).select("_q", F.col("_score").alias("_floor"))
    reaching = (
        queries.join(cut(floors, "floors"), "_q", "left")
        .withColumn("_floor", F.coalesce("_floor", none))
        .join(parts.select("_dim", "_class", "_parts", "_longest"), "_dim")
        .where(F.col("_floor") <= F.col("_len") * F.col("_longest") * (1 + 1e-9))
    )
    reach = reaching.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).select(
        *other, "_block", "_q", F.col("_v").alias("_w"), "_floor"
    )
    # A bucket meets only the blocks that hold a query for its class.
    asking = cut(reaching.select("_dim", "_class", "_block").distinct(), "asking")
    held = buckets.join(asking, ["_dim", "_class"]).select(*met, "_id", "_v")
    found = held.groupBy(*met).cogroup(reach.groupBy(*theirs)).applyInPandas(_search(k), schema)
    return _best_of(found, k).select(
        F.col("_q").alias("query_id"),
        (F.col("_rank") + 1).cast("int").alias("rank"),
        F.col("_id").alias(id_column),
        F.col("_score").alias("score"),
    )
