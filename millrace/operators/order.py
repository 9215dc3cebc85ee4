"""Order statistics over whole tables without a single sorting task.

All rest on `running_total`: rows are range-partitioned on their order key, each range is summed
on its own, and the ranges' totals (one row per shuffle partition) are added up and handed back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.session import cut_lineage


def running_total(
    df: DataFrame, order_by: Sequence[str | Column], weights: Mapping[str, str]
) -> DataFrame:
    """Add running sums over the global order `order_by`, which must tell all rows apart.

    `weights` maps each new column to the column it sums, the row itself included.
    """
    placed, ranges = _ranges(df, order_by, weights)
    inside = W.partitionBy("_range").orderBy(*order_by).rowsBetween(W.unboundedPreceding, 0)
    summed = placed.select(
        "*", *[F.sum(weight).over(inside).alias(f"_in_{out}") for out, weight in weights.items()]
    ).join(F.broadcast(ranges), "_range")
    return summed.select(
        *df.columns, *[(F.col(f"_in_{out}") + F.col(f"_before_{out}")).alias(out) for out in weights]
    )


def _ranges(
    df: DataFrame, order_by: Sequence[str | Column], weights: Mapping[str, str]
) -> tuple[DataFrame, DataFrame]:
    """Rows with the number of their `_range`, and per range its sums and the sums of all before it.

    Ranges are fixed in a written copy, so that every use sees the same numbers. There are at most
    `spark.sql.shuffle.partitions` of them, which bounds the second table.
    """
    placed = cut_lineage(df.repartitionByRange(*order_by).withColumn("_range", F.spark_partition_id()))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sums = placed.groupBy("_range").agg(*[F.sum(weight).alias(f"_of_{out}") for out, weight in weights.items()])
    return placed, sums.select(
        "*", *[F.coalesce(F.sum(f"_of_{out}").over(before), F.lit(0)).alias(f"_before_{out}") for out in weights]
    )


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> DataFrame:
    """One row with `q0, q1, …`: the smallest value that at least each share of the rows does not exceed.

    Values are counted and placed in ranges; only ranges that hold one of the wanted values are
    sorted.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    placed, ranges = _ranges(counted, [column], {"upto": "_n"})
    total = F.sum("_of_upto").over(W.partitionBy())
    target = F.greatest(F.lit(1), F.ceil(F.col("_total") * F.col("share")))
    asked = F.array(*[F.struct(F.lit(n).alias("place"), F.lit(float(s)).alias("share")) for n, s in enumerate(shares)])
    wanted = (
        ranges.withColumn("_total", total)
        .select("*", F.inline(asked))
        .withColumn("_target", target)
        .where((F.col("_before_upto") < F.col("_target")) & (F.col("_before_upto") + F.col("_of_upto") >= F.col("_target")))
        .select("_range", "place", "_before_upto", "_target")
    )
    inside = W.partitionBy("_range", "place").orderBy(column).rowsBetween(W.unboundedPreceding, 0)
    reached = (
        placed.join(F.broadcast(wanted), "_range")
        .withColumn("_upto", F.col("_before_upto") + F.sum("_n").over(inside))
        .where(F.col("_upto") >= F.col("_target"))
    )
    return reached.agg(
        *[F.min(F.when(F.col("place") == n, F.col(column))).alias(f"q{n}") for n in range(len(shares))]
    )


# Rank error of a sketch of `SKETCH_K`, as a share of the rows, with a probability of 0.99: 2.296 / k ** 0.9021
# for one quantile, as published for KLL sketches.
SKETCH_K = 800


def rank_error(k: int = SKETCH_K) -> float:
    return 2.296 / k**0.9021


def quantile_sketches(df: DataFrame, keys: Sequence[str | Column], column: str, k: int = SKETCH_K) -> DataFrame:
    """`*keys, sketch`: a KLL sketch of the column per group, some kilobytes whatever the group's size.

    Sketches can be kept and merged later, per day into months, without the rows. Missing values do not count.
    """
    return df.where(F.col(column).isNotNull()).groupBy(*keys).agg(
        F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(k)).alias("sketch")
    )


def sketched_quantiles(sketches: DataFrame, shares: Sequence[float], keys: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """`*keys, n, share, value`: quantiles of merged sketches, each within `rank_error` of its rank."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("_merged"))
    found = [
        F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("_merged", F.lit(float(s))).alias("value"))
        for s in shares
    ]
    return merged.select(*keys, F.kll_sketch_get_n_double("_merged").alias("n"), F.inline(F.array(*found)))


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`place, value, rank` for each distinct value of the numeric column at `place` in `columns`.

    Equal values share the mean of their ranks; missing values have none. All columns are ranked
    together: values are counted first, and one running total over (place, value) serves them all.
    """
    cells = F.array(*[F.struct(F.lit(n).alias("place"), F.col(c).cast("double").alias("value")) for n, c in enumerate(columns)])
    counted = (
        df.select(F.explode(cells).alias("cell"))
        .select("cell.*")
        .where(F.col("value").isNotNull())
        .groupBy("place", "value")
        .agg(F.count("*").alias("_n"))
    )
    ranked = cut_lineage(running_total(counted, ["place", "value"], {"_upto": "_n"}))
    # One row per column.
    firsts = ranked.groupBy("place").agg(F.min(F.col("_upto") - F.col("_n")).alias("_before"))
    rank = F.col("_upto") - F.col("_before") - (F.col("_n") - 1) / F.lit(2.0)
    return ranked.join(F.broadcast(firsts), "place").select("place", "value", rank.alias("rank"))


def numbered(df: DataFrame, order_by: Sequence[str | Column], out: str) -> DataFrame:
    """Number the rows from 0 in the global order `order_by`."""
    counted = running_total(df.withColumn("_one", F.lit(1).cast("bigint")), order_by, {out: "_one"})
    return counted.withColumn(out, F.col(out) - 1).drop("_one")


def first_by_key(df: DataFrame, key: str, tie: str, n: Column, step: int = 4) -> DataFrame:
    """The `n` rows with the smallest (`key`, `tie`), where `key` holds hex digits that spread evenly.

    `n` is a single value from the plan, not a number on the driver. Rows are counted by the first
    `step` digits; whole buckets are kept below the cut and only the bucket at the cut is sorted,
    a 16**step-th part of the rows.
    """
    bucket = F.substring(key, 1, step)
    counts = df.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_size"))
    # At most 16**step rows, whatever the size of the input.
    before = counts.select(
        "_bucket",
        "_size",
        F.coalesce(F.sum("_size").over(W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        .alias("_before"),
        n.alias("_wanted"),
    ).where(F.col("_before") < F.col("_wanted"))
    reached = df.withColumn("_bucket", bucket).join(F.broadcast(before), "_bucket")
    whole = reached.where(F.col("_before") + F.col("_size") <= F.col("_wanted"))
    cut = reached.where(F.col("_before") + F.col("_size") > F.col("_wanted"))
    place = F.row_number().over(W.partitionBy("_bucket").orderBy(key, tie))
    part = (
        cut.withColumn("_place", place)
        .where(F.col("_before") + F.col("_place") <= F.col("_wanted"))
        .drop("_place")
    )
    return whole.unionByName(part).select(*df.columns)
