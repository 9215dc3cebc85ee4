"""Word counts over streams of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.text import word_count, words


def running_word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """`word, n` over all lines so far; run it in complete or update mode."""
    return word_count(df, column)


def windowed_word_count(
    df: DataFrame,
    length: str = "10 seconds",
    slide: str | None = "5 seconds",
    column: str = "value",
    time: str = "timestamp",
    delay: str | None = None,
) -> DataFrame:
    """`start, end, word, n` per window of arrival time, words split at blanks."""
    if delay is not None:
        df = df.withWatermark(time, delay)
    window = F.window(time, length, slide) if slide else F.window(time, length)
    return (
        df.select(F.explode(words(column, "\\s")).alias("word"), time)
        .groupBy(window.alias("window"), "word")
        .agg(F.count("*").alias("n"))
        .select("window.*", "word", "n")
    )
