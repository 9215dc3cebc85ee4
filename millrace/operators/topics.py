"""Keyed records kept as tables: partitioning by key, offsets, order, group lag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

MIN_BUCKET_ROWS = 65_536
MAX_BUCKETS = 1_000_000


def assign_partition(df: DataFrame, partitions: int, key: str = "key") -> DataFrame:
    """Same key, same topic partition. Only a column: where rows are stored is a separate matter."""
    return df.withColumn("partition", F.pmod(F.hash(key), F.lit(partitions)).cast("int"))


def assign_offsets(df: DataFrame, sequence: str, bucket_rows: int | None = None) -> DataFrame:
    """Consecutive offsets from 0 per `partition`, in the order of the unique integer `sequence`.

    A partition may hold most of the rows, so it is never numbered in one task: rows are numbered
    within buckets of the sequence, and bucket sizes are added up beforehand. The bucket width is
    taken from the span of the sequence, so that neither the rows of a bucket nor the buckets
    exceed about a million each; a sequence with large gaps is better numbered by
    `millrace.operators.order.numbered` first.
    """
    if bucket_rows is None:
        low, high = df.agg(F.min(sequence), F.max(sequence)).first()
        bucket_rows = max(MIN_BUCKET_ROWS, ((high or 0) - (low or 0)) // MAX_BUCKETS + 1)
    bucketed = df.withColumn("_bucket", F.call_function("div", F.col(sequence), F.lit(bucket_rows)))
    before = W.partitionBy("partition").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy("partition", "_bucket")
        .agg(F.count("*").alias("_size"))
        .select("partition", "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    inside = W.partitionBy("partition", "_bucket").orderBy(sequence)
    return (
        bucketed.withColumn("_place", F.row_number().over(inside) - 1)
        .join(starts, ["partition", "_bucket"])
        .withColumn("offset", (F.col("_start") + F.col("_place")).cast("bigint"))
        .select(*df.columns, "offset")
    )


def in_partition_order(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Lay records out so that reading files in order replays each topic partition in order.

    Ranges over (partition, offset) keep that order and still cut a large partition into many tasks.
    """
    keys = ["partition", "offset"]
    ranged = df.repartitionByRange(tasks, *keys) if tasks else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def order_violations(df: DataFrame) -> DataFrame:
    """Per key: how often the next offset of its partition carries an earlier time stamp.

    Neighbours are found by joining on offset + 1, which needs no sorted group per key.
    """
    this = df.select("partition", "offset", "key", "timestamp")
    following = df.select("partition", (F.col("offset") - 1).alias("offset"), F.col("timestamp").alias("_next"))
    return (
        this.join(following, ["partition", "offset"], "left")
        .groupBy("key")
        .agg(
            F.count("*").alias("records"),
            F.min("partition").alias("first_partition"),
            F.max("partition").alias("last_partition"),
            F.count(F.when(F.col("_next") < F.col("timestamp"), 1)).alias("violations"),
        )
    )


def group_lag(records: DataFrame, committed: DataFrame) -> DataFrame:
    """`partition, current_offset, log_end_offset, lag` of a consumer group.

    `committed(partition, current_offset)`; a partition without a commit counts from 0.
    """
    ends = records.groupBy("partition").agg((F.max("offset") + 1).alias("log_end_offset"))
    current = F.coalesce(F.col("current_offset"), F.lit(0).cast("bigint"))
    return ends.join(committed, "partition", "left").select(
        "partition",
        current.alias("current_offset"),
        "log_end_offset",
        (F.col("log_end_offset") - current).alias("lag"),
    )


def key_value_listing(df: DataFrame, separator: str = ":") -> DataFrame:
    """`partition, offset, line` with `key:value`, a missing key shown as null."""
    line = F.concat_ws(separator, F.coalesce(F.col("key"), F.lit("null")), F.col("value"))
    return df.select("partition", "offset", line.alias("line"))


def write_topic(df: DataFrame, path: str, tasks: int | None = None) -> DataFrame:
    """Keep records as a table laid out in partition order; returns it as read back."""
    in_partition_order(df, tasks).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


