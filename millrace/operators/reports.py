"""Reports: emergency calls per period and area, course views, yearly maxima."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.scalars import (
    SCORE_BANDS,
    SCORE_BANDS_STRICT,
    score_bands,
    signed_number,
    us_date,
    us_timestamp,
)
from millrace.operators.tables import group_ratio, top_group, valid_measurements
from millrace.sources.files import read_fixed_width

# Positions in a weather line.
WEATHER_FIELDS = {"year": (15, 19), "temperature": (87, 92), "quality": (92, 93)}


def type_calls(df: DataFrame) -> DataFrame:
    """Raw calls to typed ones: two dates and a timestamp from text."""
    return df.withColumns(
        {
            "CallDate": us_date("CallDate"),
            "WatchDate": us_date("WatchDate"),
            "AvailableDtTm": us_timestamp("AvailableDtTm"),
        }
    )


def in_year(df: DataFrame, year: int, date: str = "CallDate") -> DataFrame:
    """Rows of one year as a range on the raw date, which file statistics can prune."""
    start, end = F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year + 1}-01-01").cast("date")
    return df.where((F.col(date) >= start) & (F.col(date) < end))


def call_types(df: DataFrame, year: int) -> DataFrame:
    """Distinct call types of a year in alphabetical order."""
    return in_year(df, year).select("CallType").distinct().orderBy("CallType")


def calls_by(
    df: DataFrame, key: str | Column, year: int, name: str, metric: str = "count", top: bool = False
) -> DataFrame:
    """Calls of a year per group, largest first. `metric`: "count" or "avg_delay" (rounded half-even)."""
    measure = F.count("*") if metric == "count" else F.avg("Delay")
    column = F.col(key) if isinstance(key, str) else key
    calls = in_year(df, year)
    if top:
        return top_group(calls, column, measure, name, metric)
    report = calls.groupBy(column.alias(name)).agg(measure.alias(metric))
    if metric == "avg_delay":
        report = report.withColumn(metric, F.bround(metric, 2))
    return report.orderBy(F.desc(metric), name)


def view_share(views: DataFrame, chapters: DataFrame, distinct_views: bool = False) -> DataFrame:
    """`course_id, user_id, share`: chapters a user watched in a course, over the course's chapters.

    Repeated views count each time unless `distinct_views`.
    """
    per_course = chapters.groupBy("course_id").agg(F.count("chapter_id").alias("chapters"))
    if distinct_views:
        views = views.distinct()
    return group_ratio(watched_chapters(views, chapters), per_course, "course_id", "watched", "chapters", "share")


def watched_chapters(views: DataFrame, chapters: DataFrame) -> DataFrame:
    """`user_id, course_id, watched`: views of chapters of a course by a user."""
    return (
        views.join(chapters, "chapter_id")
        .groupBy("user_id", "course_id")
        .agg(F.count("chapter_id").alias("watched"))
    )


def viewing_report(
    views: DataFrame, chapters: DataFrame, titles: DataFrame, user_id: int, distinct_views: bool = False
) -> DataFrame:
    """`course_id, title, total` for one user. The filter reaches the scan of the views."""
    return (
        view_share(views.where(F.col("user_id") == user_id), chapters, distinct_views)
        .join(titles, "course_id")
        .select("course_id", "title", score_bands("share", SCORE_BANDS, 0).cast("int").alias("total"))
    )


def course_ranking(views: DataFrame, chapters: DataFrame, titles: DataFrame) -> DataFrame:
    """`course_id, total, title`: scores of all users added up per course, best course first.

    Users with equal counts in a course have equal scores: they are counted before the join.
    """
    score = score_bands("share", SCORE_BANDS_STRICT, 0, strict=True)
    per_course = chapters.groupBy("course_id").agg(F.count("chapter_id").alias("chapters"))
    alike = watched_chapters(views, chapters).groupBy("course_id", "watched").agg(F.count("*").alias("users"))
    return (
        alike.join(per_course, "course_id")
        .withColumn("share", F.try_divide("watched", "chapters"))
        .groupBy("course_id")
        .agg(F.sum(score * F.col("users")).alias("total"))
        .join(titles, "course_id")
        .orderBy(F.desc("total"), "course_id")
    )


def parse_weather(lines: DataFrame) -> DataFrame:
    """`year, temperature, quality` from fixed-width lines; the sign belongs to the number."""
    fields = read_fixed_width(lines, WEATHER_FIELDS)
    return fields.withColumn("temperature", signed_number("temperature"))


def max_by_year(lines: DataFrame) -> DataFrame:
    """`year, max_temp` over measurements that are present and of good quality."""
    good = valid_measurements(parse_weather(lines), "temperature", "quality")
    return good.groupBy("year").agg(F.max("temperature").alias("max_temp"))


def pivot_sums(df: DataFrame, column: str, values: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One count column per named value, by conditional sums in a single aggregate."""
    return df.groupBy(*keys).agg(
        *[F.sum(F.when(F.col(column) == value, 1).otherwise(0)).alias(value.lower()) for value in values]
    )
