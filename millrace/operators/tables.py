"""Operators over plain tables: lookups, ratios, bounds, bands, samples, top groups."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.scalars import ERROR_EDGES, order_key
from millrace.operators.order import first_by_key
from millrace.session import cut_lineage


def lookup(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Bring in the columns of a dimension and drop the key. Catalyst broadcasts it if it is small."""
    return df.join(dimension, key).drop(key)


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without any null (or NaN) in the named columns, by default in all."""
    return df.na.drop(subset=list(columns) if columns else None)


def within(df: DataFrame, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows whose columns all lie in their closed range, e.g. a bounding box."""
    for column, (low, high) in limits.items():
        df = df.where(F.col(column).between(low, high))
    return df


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [name for name in df.columns if name.startswith(prefix)]


def valid_measurements(
    df: DataFrame, value: str, quality: str, missing: int = 9999, codes: str = "01459"
) -> DataFrame:
    """Rows whose value is not the missing marker and whose quality code is one of `codes`."""
    return df.where((F.col(value) != missing) & F.col(quality).rlike(f"^[{codes}]$"))


def deviation_bounds(df: DataFrame, column: str, k: float = 1.0) -> DataFrame:
    """One row `low, high`: mean minus and plus `k` sample standard deviations, in one scan."""
    mean, spread = F.avg(column), F.stddev(column)
    return df.agg((mean - k * spread).alias("low"), (mean + k * spread).alias("high"))


def drop_outliers(df: DataFrame, column: str, k: float = 1.0) -> DataFrame:
    """Rows within `k` standard deviations of the mean.

    The two bounds are computed right away and become literals: one scan for them, and a filter
    that the source can use, however many such steps follow each other.
    """
    bounds = deviation_bounds(df, column, k).first()
    return df.where(F.col(column).between(F.lit(bounds["low"]), F.lit(bounds["high"])))


def error_bands(
    df: DataFrame, label: str, prediction: str = "prediction", edges: Sequence[float] = ERROR_EDGES
) -> DataFrame:
    """`range, n`: rows per band of absolute error; each edge belongs to the band below it."""
    margin = F.abs(F.col(prediction) - F.col(label))
    band: Column | None = None
    low = 0.0
    for edge in edges:
        name = f"{low:g}-{edge:g}"
        band = F.when(margin <= edge, name) if band is None else band.when(margin <= edge, name)
        low = edge
    named = F.lit(f"{low:g}+") if band is None else band.otherwise(f"{low:g}+")
    return df.groupBy(named.alias("range")).agg(F.count("*").alias("n"))


def top_group(df: DataFrame, key: str | Column, measure: Column, name: str, measure_name: str) -> DataFrame:
    """The group with the largest measure; the smaller key wins a tie."""
    column = F.col(key) if isinstance(key, str) else key
    return (
        df.groupBy(column.alias(name))
        .agg(measure.alias(measure_name))
        .orderBy(F.desc(measure_name), name)
        .limit(1)
    )


def group_ratio(parts: DataFrame, wholes: DataFrame, key: str, part: str, whole: str, out: str) -> DataFrame:
    """Part count divided by the count of the group it belongs to.

    Groups may be few and large. Their counts are written first, so that Catalyst knows how small they are and
    broadcasts them, or else AQE may split the parts of a large group.
    """
    return parts.join(cut_lineage(wholes), key).withColumn(out, F.try_divide(part, whole)).drop(part, whole)


def shuffled(df: DataFrame, *ids: str, seed: int = 42) -> DataFrame:
    """Random but repeatable order of the whole table."""
    return df.orderBy(order_key(*ids, seed=seed), *ids)


def in_share(ids: Sequence[str], share: float = 0.8, seed: int = 42) -> Column:
    """Whether a row belongs to the first part of `hash_split`; written beside the rows, the hash is made once."""
    # As text: digits in order are numbers in order, and turning each row's into a number takes longer than the hash.
    digits = F.substring(order_key(*ids, seed=seed), 1, 8)
    last = math.ceil(share * 2**32) - 1
    return digits <= f"{min(last, 2**32 - 1):08x}" if last >= 0 else digits < ""


def hash_split(
    df: DataFrame, ids: Sequence[str], share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the row's identity: repeatable, whatever the partitioning, and no shuffle."""
    inside = in_share(ids, share, seed)
    return df.where(inside), df.where(~inside)


def balance(
    df: DataFrame, label: str, id_column: str, kept: object = 1, sampled: object = 0, seed: int = 42
) -> DataFrame:
    """All rows of class `kept` and as many random rows of class `sampled` (all, if there are fewer)."""
    minority = df.where(F.col(label) == F.lit(kept))
    majority = df.where(F.col(label) == F.lit(sampled)).withColumn("_key", order_key(id_column, seed=seed))
    wanted = minority.agg(F.count("*").alias("n")).scalar()
    return minority.unionByName(first_by_key(majority, "_key", id_column, wanted).drop("_key"))
