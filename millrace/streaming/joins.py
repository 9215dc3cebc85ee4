"""Joins of streams with tables and with streams. Each works on batches as well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

HOW = ("inner", "left_outer", "right_outer", "full_outer", "left_semi")
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def enrich(stream: DataFrame, dimension: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join a stream with a table; stateless. `how`: "inner", or "left_outer" to keep unmatched rows.

    A right outer join is possible with the stream as `dimension`, on the right.
    """
    return stream.join(dimension, key, how)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    within: str,
    left_delay: str | None = None,
    right_delay: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Right rows with equal keys that follow a left row by at most `within`.

    Column names other than the keys must differ. Both watermarks together with the time range
    let a stream drop its state, and tell an outer join when a left row stays alone.

    Time is also cut into slices of length `within`: a left row belongs to its own slice, a right
    row to its own and to the one before, so every match meets in exactly one slice. Joining on
    keys and slice spreads a key that has most of the rows over many tasks. A right outer join
    gives the left rows two slices instead, for only rows of the other side may be doubled when
    unmatched rows are kept; a full one adds the lone right rows of it to the left outer join.
    Lone right rows show their own key. `how`: inner, left_outer, right_outer, full_outer, left_semi.
    """
    if how not in HOW:
        raise ValueError(f"unknown join {how!r}, not one of {', '.join(HOW)}")
    if left_delay:
        left = left.withWatermark(left_time, left_delay)
    if right_delay:
        right = right.withWatermark(right_time, right_delay)
    if how == "full_outer":
        sides = (keys, left_time, right_time, within, None, None)
        lone = interval_join(left, right, *sides, "right_outer").where(F.col(left_time).isNull())
        return interval_join(left, right, *sides, "left_outer").unionByName(lone)
    width = F.lit(seconds(within) * 1_000_000)

    def slice_of(column: str) -> Column:
        return F.call_function("div", F.unix_micros(F.col(column).cast("timestamp")), width)

    columns = [*left.columns, *[c for c in right.columns if c not in keys]]
    early, late = slice_of(left_time), slice_of(right_time)
    if how == "right_outer":
        early = F.explode(F.array(early, early + 1))
    else:
        late = F.explode(F.array(late - 1, late))
    left = left.withColumn("_slice", early)
    renamed = {key: f"_right_{key}" for key in keys}
    right = right.withColumnsRenamed(renamed).withColumn("_right_slice", late)
    match = F.col("_slice") == F.col("_right_slice")
    for key, other in renamed.items():
        match = match & (F.col(key) == F.col(other))
    match = match & (F.col(right_time) >= F.col(left_time))
    match = match & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {within}"))
    joined = left.join(right, match, how)
    if how == "left_semi":
        return joined.drop("_slice")
    if how == "right_outer":
        joined = joined.withColumns({key: F.coalesce(key, other) for key, other in renamed.items()})
    return joined.select(*columns)


def window_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    length: str,
    time: str = "event_time",
    left_delay: str | None = None,
    right_delay: str | None = None,
) -> DataFrame:
    """`start, end, *keys, left_n, right_n` for tumbling windows in which both sides have the keys.

    Each side is counted per window first, so a busy key meets as one row per window and not as
    all its pairs.
    """
    # The window must stay the column the watermark is attached to, so it is expanded at the end.
    def counted(side: DataFrame, delay: str | None, out: str) -> DataFrame:
        if delay:
            side = side.withWatermark(time, delay)
        return side.groupBy(F.window(time, length).alias("window"), *keys).agg(F.count("*").alias(out))

    both = counted(left, left_delay, "left_n").join(
        counted(right, right_delay, "right_n"), ["window", *keys]
    )
    return both.select("window.*", *keys, "left_n", "right_n")


def seconds(interval: str) -> int:
    """Length of an interval such as "1 hour" or "90 seconds"."""
    amount, unit = interval.split()
    return int(amount) * UNITS[unit.rstrip("s")]


