"""Keyed-record topics: connector options, encoding and decoding, read positions.

The functions below the option builders work on any DataFrame with the record schema,
whether it comes from a broker or from a table that keeps the records.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RECORD_SCHEMA = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP, timestampType INT"
)


def source_options(
    servers: str,
    topics: str | Sequence[str],
    start: str | int | datetime | Mapping[str, Mapping[int, int]] = "latest",
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. `start` is earliest, latest, a time, or offsets per partition."""
    import json

    names = topics if isinstance(topics, str) else ",".join(topics)
    options = {"kafka.bootstrap.servers": servers, "subscribe": names}
    if isinstance(start, datetime):
        options["startingTimestamp"] = str(int(start.timestamp() * 1000))
    elif isinstance(start, Mapping):
        options["startingOffsets"] = json.dumps(
            {t: {str(p): o for p, o in parts.items()} for t, parts in start.items()}
        )
    else:
        options["startingOffsets"] = str(start)
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def sink_options(servers: str, topic: str | None = None) -> dict[str, str]:
    """Options of the Kafka sink; without `topic` each row must carry its own topic column."""
    options = {"kafka.bootstrap.servers": servers}
    if topic is not None:
        options["topic"] = topic
    return options


def kafka_source(spark: SparkSession, options: Mapping[str, str], stream: bool = True) -> DataFrame:
    """Records of the subscribed topics. Needs the Kafka connector on the cluster's class path."""
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**options).load()


def decode_records(df: DataFrame) -> DataFrame:
    """Key and value from binary to text; all other record columns stay."""
    return df.withColumns(
        {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
    )


def encode_records(
    df: DataFrame,
    value: str | Column,
    key: str | Column | None = None,
    topic: str | Column | None = None,
) -> DataFrame:
    """Frame a sink accepts: binary `value`, optional binary `key`, optional `topic`.

    A row without a value cannot be sent and is rejected when it is reached.
    """
    payload = _column(value)
    checked = F.when(
        payload.isNull(), F.raise_error(F.lit("a record needs a value")).cast("binary")
    ).otherwise(payload.cast("string").cast("binary"))
    columns = [checked.alias("value")]
    if key is not None:
        columns.insert(0, _column(key).cast("string").cast("binary").alias("key"))
    if topic is not None:
        columns.append(_column(topic).alias("topic"))
    return df.select(*columns)


def read_position(
    df: DataFrame,
    start: str | int | datetime | timedelta = "earliest",
    limit: int | None = None,
    committed: DataFrame | None = None,
) -> DataFrame:
    """Records from a start position onwards, at most `limit` per partition.

    `start`: "earliest"; "latest" (nothing that is stored yet); a datetime (first record at or
    after it); a timedelta (that long before the newest record of the table); an int, which
    shifts the positions in `committed(partition, current_offset)` by that many records.
    Offsets are consecutive within a partition, so `limit` is a range on the offset and no
    partition has to be sorted.
    """
    if start == "earliest":
        chosen = df
    elif start == "latest":
        chosen = df.where(F.lit(False))
    elif isinstance(start, (datetime, timedelta)):
        if isinstance(start, datetime):
            since = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
        else:
            newest = df.agg(F.max("timestamp").alias("newest")).scalar()
            since = newest - F.make_dt_interval(secs=F.lit(start.total_seconds()))
        # The position is an offset: later records count even if their time stamp is older.
        where = (
            df.where(F.col("timestamp") >= since)
            .groupBy("partition")
            .agg(F.min("offset").alias("_from"))
        )
        chosen = df.join(where, "partition").where(F.col("offset") >= F.col("_from")).drop("_from")
    elif isinstance(start, int):
        if committed is None:
            raise ValueError("shifting needs the committed offsets")
        where = committed.select(
            "partition", F.greatest(F.lit(0), F.col("current_offset") + start).alias("_from")
        )
        chosen = (
            df.join(where, "partition", "left")
            .where(F.col("offset") >= F.coalesce(F.col("_from"), F.lit(0)))
            .drop("_from")
        )
    else:
        raise ValueError(f"unknown start position {start!r}")
    if limit is None:
        return chosen
    first = chosen.groupBy("partition").agg(F.min("offset").alias("_first"))
    return (
        chosen.join(first, "partition")
        .where(F.col("offset") < F.col("_first") + limit)
        .drop("_first")
    )


def _column(item: str | Column) -> Column:
    return F.col(item) if isinstance(item, str) else item
