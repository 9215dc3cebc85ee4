"""End-to-end jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars as X
from millrace.operators import logs, reports, tables as O, text
from millrace.plans import views as V
from millrace.plans.catalog import query
from millrace.plans.functions import trip_distance
from millrace.plans.tables import LOWER_BLANK_SQL, SPACE_SQL, document_index, source_lookup
from millrace.session import new_folder
from millrace.sources import files

table = V.table


@query(
    "r01_word_count",
    f"{SPACE_SQL} SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1",
)
def r01(spark, sf_dir):
    counts = text.word_count(V.text_lines(table(spark, sf_dir, "documents")), tokenizer="whitespace")
    return counts.orderBy(F.desc("n"), "word")


@query(
    "r02_inverted_index",
    f"""{LOWER_BLANK_SQL} SELECT word, 0 AS block, sum(n)::BIGINT AS n, string_agg(file || ':' || n, ';' ORDER BY file) AS postings
        FROM (SELECT word, file, count(*) AS n FROM w GROUP BY 1, 2) GROUP BY 1""",
)
def r02(spark, sf_dir):
    return document_index(spark, sf_dir, form="postings", tokenizer="whitespace", lower=True)


@query(
    "r03_max_temperature",
    f"""WITH {V.WEATHER_SQL} SELECT year, max(t) AS max_temp
        FROM (SELECT substr(value, 16, 4) AS year, CAST(substr(value, 88, 5) AS INTEGER) AS t, substr(value, 93, 1) AS q
              FROM weather) WHERE t <> 9999 AND q IN ('0', '1', '4', '5', '9') GROUP BY 1""",
)
def r03(spark, sf_dir):
    return reports.max_by_year(V.weather_lines(table(spark, sf_dir, "orders"))).orderBy("year")


YEAR_SQL = f"""WITH {V.CALLS_SQL}, y AS (SELECT * FROM calls WHERE extract(year FROM "CallDate") = 1998)"""


@query("r04_call_types", f'{YEAR_SQL} SELECT DISTINCT "CallType" FROM y')
def r04_types(spark, sf_dir):
    return reports.call_types(V.typed_calls(spark, sf_dir), 1998)


@query(
    "r04_calls_per_month",
    f'{YEAR_SQL} SELECT CAST(extract(month FROM "CallDate") AS INTEGER) AS month, count(*) AS "count" FROM y GROUP BY 1',
)
def r04_months(spark, sf_dir):
    return reports.calls_by(V.typed_calls(spark, sf_dir), F.month("CallDate"), 1998, "month")


@query(
    "r04_busiest_area",
    f"""{YEAR_SQL} SELECT "Neighborhood" AS neighborhood, count(*) AS "count" FROM y GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 1""",
)
def r04_busiest(spark, sf_dir):
    return reports.calls_by(V.typed_calls(spark, sf_dir), "Neighborhood", 1998, "neighborhood", top=True)


@query(
    "r04_mean_delays",
    f"""{YEAR_SQL} SELECT "Neighborhood" AS neighborhood, CAST(round_even(avg("Delay"), 2) AS DOUBLE) AS avg_delay
        FROM y GROUP BY 1""",
)
def r04_delays(spark, sf_dir):
    return reports.calls_by(V.typed_calls(spark, sf_dir), "Neighborhood", 1998, "neighborhood", "avg_delay")


@query(
    "r04_busiest_week",
    f"""{YEAR_SQL} SELECT CAST(extract(week FROM "CallDate") AS INTEGER) AS week, count(*) AS "count" FROM y
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
)
def r04_week(spark, sf_dir):
    return reports.calls_by(V.typed_calls(spark, sf_dir), F.weekofyear("CallDate"), 1998, "week", top=True)


@query("r05_typed_snapshot", f"WITH {V.CALLS_SQL} SELECT * REPLACE (round(\"Delay\", 6) AS \"Delay\") FROM calls")
def r05(spark, sf_dir):
    raw_path, typed_path = new_folder(spark, "csv"), new_folder(spark, "snapshot")
    files.write_csv(V.raw_calls(spark, sf_dir), raw_path, header=True)
    schema = (
        "CallNumber BIGINT, CallType STRING, CallDate STRING, WatchDate STRING, AvailableDtTm STRING, "
        "Neighborhood STRING, Delay DOUBLE"
    )
    typed = reports.type_calls(files.read_csv(spark, raw_path, schema))
    snapshot = files.write_parquet(logs.plain_times(typed, "AvailableDtTm"), typed_path)
    return snapshot.withColumn("Delay", F.round("Delay", 6))


@query(
    "r06_viewing_report",
    f"""WITH {V.COURSES_SQL}, {V.SHARE_SQL}
        SELECT course_id, title, CASE WHEN share >= 0.9 THEN 10 WHEN share >= 0.5 THEN 4 WHEN share >= 0.25 THEN 2
               ELSE 0 END AS total FROM share JOIN titles USING (course_id) WHERE user_id = 13""",
)
def r06_user(spark, sf_dir):
    return reports.viewing_report(*V.course_tables(spark, sf_dir), user_id=13)


@query(
    "r06_course_ranking",
    f"""WITH {V.COURSES_SQL}, {V.SHARE_SQL}
        SELECT course_id, CAST(sum(CASE WHEN share > 0.9 THEN 10 WHEN share > 0.5 THEN 6 WHEN share > 0.25 THEN 2
               ELSE 0 END) AS BIGINT) AS total, title FROM share JOIN titles USING (course_id) GROUP BY 1, 3""",
)
def r06_ranking(spark, sf_dir):
    return reports.course_ranking(*V.course_tables(spark, sf_dir))


SLIDING_SQL = f"""WITH {V.LOG_SQL}, b AS (SELECT level, source, time_bucket(INTERVAL 5 MINUTES, ts) AS bucket FROM log)
  SELECT bucket - s * INTERVAL 5 MINUTES AS start, bucket - s * INTERVAL 5 MINUTES + INTERVAL 10 MINUTES AS "end",
         source, level, count(*) AS n FROM b, (VALUES (0), (1)) v(s) GROUP BY 1, 2, 3, 4"""


@query("r08_log_report_batch", SLIDING_SQL)
def r08(spark, sf_dir):
    parsed = logs.parse_log(V.stored_lines(spark, sf_dir))
    counted = logs.windowed_counts(parsed, "10 minutes", "5 minutes", ["source", "level"])
    return logs.plain_times(logs.ordered_report(counted, "source", "level"), "start", "end")


@query(
    "r09_band_report",
    f"""WITH {V.LOG_SQL}
        SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS start,
               time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES AS "end", source AS source_string,
               count(CASE WHEN level NOT IN ('ERROR', 'FATAL') THEN 1 END) AS low,
               count(CASE WHEN level IN ('ERROR', 'FATAL') THEN 1 END) AS high
        FROM log GROUP BY 1, 2, 3""",
)
def r09(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    names = F.broadcast(source_lookup(spark))  # five rows by construction
    messages = events.select(
        (F.col("user_id") % 5).cast("int").alias("source"), V.log_level().alias("level"), F.col("ts").alias("event_time")
    )
    return logs.band_counts(O.lookup(messages, names, "source"), keys=["source_string"]).orderBy("start", "source_string")


@query(
    "r10_trips_per_hour",
    f"WITH {V.TRIPS_SQL} SELECT hour, count(*) AS n, round(avg(distance / (trip_duration / 3600)), 6) AS mean_speed, "
    "round(sum(distance), 3) AS total_distance FROM distances GROUP BY 1",
)
def r10_hours(spark, sf_dir):
    return trip_statistics(spark, sf_dir, "hour")


@query(
    "r10_trips_per_day",
    f"WITH {V.TRIPS_SQL} SELECT day, count(*) AS n, round(avg(distance / (trip_duration / 3600)), 6) AS mean_speed, "
    "round(sum(distance), 3) AS total_distance FROM distances GROUP BY 1",
)
def r10_days(spark, sf_dir):
    return trip_statistics(spark, sf_dir, "day")


def measured_trips(spark, sf_dir):
    """Trips with distance, hour and day of the week; the raw times are no longer needed."""
    return (
        V.trips(table(spark, sf_dir, "lineitem"))
        .withColumns(
            {"distance": trip_distance(), "hour": F.hour("pickup_datetime"), "day": F.dayofweek("pickup_datetime")}
        )
        .drop("pickup_datetime")
    )


def trip_statistics(spark, sf_dir, period):
    trips = measured_trips(spark, sf_dir)
    return (
        trips.groupBy(period)
        .agg(
            F.count("*").alias("n"),
            F.round(F.mean(X.speed("distance", "trip_duration")), 6).alias("mean_speed"),
            F.round(F.sum("distance"), 3).alias("total_distance"),
        )
        .orderBy(period)
    )
