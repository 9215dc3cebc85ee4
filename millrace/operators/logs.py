"""Log lines: `LEVEL source yyyy-MM-dd HH:mm:ss.ffffff message…`. The same code serves batch and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.scalars import level_band, token

# Fixed value: the levels worth forwarding.
IMPORTANT = ("ERROR", "FATAL")


def important(df: DataFrame, levels: Sequence[str] = IMPORTANT, column: str = "value") -> DataFrame:
    """Records whose line starts with one of the levels. Stateless: no shuffle, no state."""
    keep = F.lit(False)
    for level in levels:
        keep = keep | F.col(column).like(f"{level}%")
    return df.where(keep).select("key", column)


def parse_log(df: DataFrame, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """`level, source, event_time`; null where a line is too short or its time is not one."""
    when = F.concat(token(column, 3), F.lit(" "), token(column, 4))
    return df.select(
        *keep,
        token(column, 1).alias("level"),
        token(column, 2).alias("source"),
        when.try_cast("timestamp").alias("event_time"),
    )


def log_key(column: str | Column = "value") -> Column:
    """Key of a log record: the source system, second word of the line."""
    return token(column, 2, " ")


def windowed_counts(
    df: DataFrame,
    length: str = "10 minutes",
    slide: str | None = None,
    keys: Sequence[str] = (),
    delay: str | None = None,
    time: str = "event_time",
) -> DataFrame:
    """`start, end, *keys, n` per tumbling or sliding event-time window.

    `delay` sets the watermark, which a stream needs to close windows and to drop its state;
    a batch ignores it.
    """
    if delay is not None:
        df = df.withWatermark(time, delay)
    return (
        df.groupBy(_window(time, length, slide).alias("window"), *keys)
        .agg(F.count("*").alias("n"))
        .select("window.*", *keys, "n")
    )


def band_counts(
    df: DataFrame,
    length: str = "5 minutes",
    keys: Sequence[str] = (),
    delay: str | None = None,
    time: str = "event_time",
) -> DataFrame:
    """`start, end, *keys, low, high`: messages per severity band and tumbling window."""
    if delay is not None:
        df = df.withWatermark(time, delay)
    band = level_band("level")
    return (
        df.groupBy(_window(time, length, None).alias("window"), *keys)
        .agg(
            F.sum(F.when(band == "LOW", 1).otherwise(0)).alias("low"),
            F.sum(F.when(band == "HIGH", 1).otherwise(0)).alias("high"),
        )
        .select("window.*", *keys, "low", "high")
    )


def session_counts(
    df: DataFrame, gap: str, keys: Sequence[str] = (), delay: str | None = None, time: str = "event_time"
) -> DataFrame:
    """`start, end, *keys, n` per session: rows of the keys that follow each other within `gap`.

    A session ends a gap after its last row. Rows are merged into sessions before they are shuffled, and
    a stream's state holds the open sessions only.
    """
    if delay is not None:
        df = df.withWatermark(time, delay)
    return (
        df.groupBy(F.session_window(time, gap).alias("session_window"), *keys)
        .agg(F.count("*").alias("n"))
        .select("session_window.*", *keys, "n")
    )


def ordered_report(df: DataFrame, *keys: str) -> DataFrame:
    """Windows in time order, the largest count of each first; `keys` break ties. Not in append mode."""
    return df.orderBy("start", F.desc("n"), *keys)


def plain_times(df: DataFrame, *columns: str) -> DataFrame:
    """Session-zone timestamps as time-zone-free ones, for reports and files."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in columns})


def _window(time: str, length: str, slide: str | None) -> Column:
    return F.window(time, length, slide) if slide else F.window(time, length)
