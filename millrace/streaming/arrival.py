"""Tables as arrivals: time-ordered files that a stream takes a few at a time, and rows that close it.

Event time moves with the files a trigger takes, so windows close, late rows are told from early
ones, and state stays as large as what is open, not as large as the table.
"""

from __future__ import annotations

import time as clock
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.session import new_folder
from millrace.streaming.run import stream_files

FILES = 3
FILE_ROWS = 4_000_000
_STEP_MS = 20


def land_in_order(waves: Sequence[DataFrame], time: str, files: int = FILES) -> str:
    """Write tables one after the other as files in the order of `time`; returns the folder.

    Each table is dealt to `files` ranges of time in one job, or to more, so that a range has about `FILE_ROWS` rows: one
    task sorts a range, and a trigger that takes a file keeps no more than its rows in state. A file source takes files by their time of
    change, so these are set in the order of arrival; that needs a store that keeps such times, as HDFS and
    local disks do. As many calls as there are files, no reading.
    """
    if not waves:
        raise ValueError("nothing to land")
    spark = waves[0].sparkSession
    path = new_folder(spark, "arrivals")
    for number, wave in enumerate(waves):
        ranges = max(files, -(-wave.count() // FILE_ROWS))
        dealt = wave.repartitionByRange(ranges, time) if ranges > 1 else wave.coalesce(1)
        dealt.sortWithinPartitions(time).write.parquet(f"{path}/wave={number:04d}")
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(f"{path}/*/part-*")
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted(str(status.getPath().toString()) for status in store.globStatus(where))
    first = int(clock.time() * 1000) - _STEP_MS * len(found)
    for place, name in enumerate(found):
        store.setTimes(jvm.org.apache.hadoop.fs.Path(name), first + _STEP_MS * place, -1)
    return path


def arrivals(spark: SparkSession, path: str, like: DataFrame, per_trigger: int = 1) -> DataFrame:
    """The files of `land_in_order` as a stream with the schema of `like`, so many files a trigger."""
    return stream_files(spark, f"{path}/*", schema=like.schema, max_files=per_trigger)


def closing_rows(df: DataFrame, time: str, *sides: Mapping[str, Any], after: str = "1 day") -> DataFrame:
    """One last row per side, `after` the newest of `df`; other columns are null unless a side names them.

    Landed as a last wave, it lets the watermark pass all that came before: every window is written, every
    lone row of an outer join too. The rows themselves stay in a window that never closes; joins that show
    them need a value to filter on. A join's streams each need a row of their own side.
    """
    last = df.agg((F.max(time) + F.expr(f"INTERVAL {after}")).alias(time)).where(F.col(time).isNotNull())

    def row(side: Mapping[str, Any]) -> DataFrame:
        return last.select(
            *[
                F.col(time) if f.name == time else F.lit(side.get(f.name)).cast(f.dataType).alias(f.name)
                for f in df.schema.fields
            ]
        )

    return reduce(DataFrame.unionByName, [row(side) for side in sides or ({},)])
