"""Operators with a state of their own: a value per key, kept between triggers and given up by a timer."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructType, TimestampType

from millrace.streaming.joins import seconds


class RepeatedErrors(StatefulProcessor):
    """Counts a key's rows as long as they follow each other within `quiet`, and reports every n-th.

    The state of a key is a count and the time of its last row. A timer at the end of the quiet time
    removes it, so state holds the keys seen lately, not all there are.
    """

    def __init__(self, names: tuple[str, str, str], every: int, quiet_ms: int):
        self.names, self.every, self.quiet_ms = names, every, quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", StructType().add("n", "long").add("last_us", "long"))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        name, time, id_ = self.names
        n, last = self.seen.get() if self.seen.exists() else (0, None)
        # The key's rows of one trigger, two numbers each, in order of time. A computed column comes without its name.
        arrived = sorted(pair for frame in rows for pair in zip(frame.iloc[:, -1].tolist(), frame[id_].tolist()))
        found = []
        for at, which in arrived:
            n = n + 1 if last is not None and at - last <= self.quiet_ms * 1000 else 1
            last = at if last is None else max(last, at)
            if n % self.every == 0:
                found.append((key[0], which, pd.Timestamp(at, unit="us"), n))
        if found:
            yield pd.DataFrame(found, columns=[name, id_, "alert_time", "errors"])
        if last is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.seen.update((int(n), int(last)))
            # A row just at the end of the quiet time still counts.
            self.handle.registerTimer(int(last) // 1000 + self.quiet_ms + 1)

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter([])

    def close(self) -> None:
        pass


def repeated_errors(
    df: DataFrame, key: str, time: str, id_column: str, every: int = 3, quiet: str = "1 hour", delay: str = "0 seconds"
) -> DataFrame:
    """`key, id, alert_time, errors`: each row that is the n-th, 2n-th, … of its key without a longer pause.

    Rows of a key are taken in order of time within a trigger; across triggers they must arrive in that
    order, and rows behind the watermark are dropped. Keys are whole in one task, as a count is.
    """
    rows = df.withWatermark(time, delay).select(key, id_column, time, F.unix_micros(time).alias("_us"))
    schema = (
        StructType().add(key, rows.schema[key].dataType).add(id_column, rows.schema[id_column].dataType)
        .add("alert_time", TimestampType()).add("errors", LongType())
    )
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=RepeatedErrors((key, time, id_column), every, seconds(quiet) * 1000),
        outputStructType=schema,
        outputMode="append",
        timeMode="eventTime",
    )

