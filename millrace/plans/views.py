"""The supplied tables seen as the inputs of the jobs: log lines, records, calls, views, trips…

Each view has a DataFrame form and, for the checks, the same rule in SQL as a common table
expression (`*_SQL`).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators.topics import assign_offsets
from millrace.session import cut_lineage, spread
from millrace.streaming.arrival import arrivals, closing_rows, land_in_order
from millrace.streaming.run import stream_files

# Names of the five source systems.
SOURCES = ["web", "e-mail", "database", "firewall", "ml-model"]
LEVELS = {"click": "DEBUG", "view": "INFO", "signup": "WARN", "error": "ERROR", "purchase": "FATAL"}
PARTITIONS = 3
TOPIC = "log.messages"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- text -----------------------------------------------------------------------------------

LINES_SQL = "lines AS (SELECT source AS file, unnest(string_split(text, chr(10))) AS value FROM documents)"


def text_lines(documents: DataFrame) -> DataFrame:
    """`file, value`: one row per line of each document."""
    texts = spread(documents.select(F.col("source").alias("file"), "text"))
    return texts.select("file", F.explode(F.split("text", "\n")).alias("value"))


# --- logs and records -------------------------------------------------------------------------

LOG_SQL = """log AS (
  SELECT event_id, user_id, ts, level, source,
         level || ' ' || source || ' ' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
           || ' This is message ' || event_id AS value
  FROM (SELECT event_id, user_id, ts,
               CASE event_type WHEN 'click' THEN 'DEBUG' WHEN 'view' THEN 'INFO' WHEN 'signup' THEN 'WARN'
                               WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'FATAL' END AS level,
               CASE user_id % 5 WHEN 0 THEN 'web' WHEN 1 THEN 'e-mail' WHEN 2 THEN 'database'
                                WHEN 3 THEN 'firewall' ELSE 'ml-model' END AS source
        FROM events))"""

RECORDS_SQL = (
    LOG_SQL
    + """, records AS (
  SELECT source AS key, value, 'log.messages' AS topic, CAST((user_id % 5) % 3 AS INTEGER) AS "partition",
         row_number() OVER (PARTITION BY (user_id % 5) % 3 ORDER BY event_id) - 1 AS "offset", ts AS "timestamp"
  FROM log)"""
)


def log_level() -> Column:
    """Severity of an event by its type."""
    level = F.lit(None).cast("string")
    for kind, name in LEVELS.items():
        level = F.when(F.col("event_type") == kind, name).otherwise(level)
    return level


def log_lines(events: DataFrame) -> DataFrame:
    """`event_id, user_id, ts, value`: each event as a log line. Works on a stream of events too."""
    source = F.element_at(F.array(*[F.lit(s) for s in SOURCES]), (F.col("user_id") % 5 + 1).cast("int"))
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    line = F.concat_ws(" ", log_level(), source, time, F.lit("This is message"), F.col("event_id").cast("string"))
    return events.select("event_id", "user_id", "ts", line.alias("value"))


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of the whole events table."""
    return log_lines(spread(table(spark, sf_dir, "events")))


def keyed_lines(events: DataFrame) -> DataFrame:
    """Log lines with their key and partition, without offsets; works on a stream."""
    return log_lines(events).select(
        "event_id",
        F.try_element_at(F.split("value", " "), F.lit(2)).alias("key"),
        "value",
        F.lit(TOPIC).alias("topic"),
        ((F.col("user_id") % 5) % PARTITIONS).cast("int").alias("partition"),
        F.col("ts").alias("timestamp"),
    )


def records(events: DataFrame) -> DataFrame:
    """`key, value, topic, partition, offset, timestamp`: the topic as a table, text columns."""
    return assign_offsets(keyed_lines(events), "event_id").select(
        "key", "value", "topic", "partition", "offset", "timestamp"
    )


def stored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic as it is kept: offsets are given once, when records are written."""
    return cut_lineage(records(table(spark, sf_dir, "events")))


def event_stream(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """The events table as a stream, its time ready for a watermark; optionally some kinds only."""
    schema = table(spark, sf_dir, "events").schema
    events = stream_files(spark, f"{sf_dir}/events.parquet", schema=schema)
    if kinds:
        events = events.where(F.col("event_type").isin(*kinds))
    return timed(events)


def event_arrivals(spark: SparkSession, sf_dir: str, *sides: Mapping[str, Any], files: int = 2) -> Callable[[], DataFrame]:
    """The events table arriving in order of time, a part of the month a trigger, then a day of silence.

    Returns what opens a stream of it. `sides` describe the last rows, one per side of a join.
    """
    events = table(spark, sf_dir, "events")
    last = closing_rows(events, "ts", *(sides or ({"event_type": "click", "user_id": 0, "event_id": -1},)))
    path = land_in_order([events, last], "ts", files)
    return lambda: timed(arrivals(spark, path, events))


def timed(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


# --- calls ------------------------------------------------------------------------------------

CALLS_SQL = """calls AS (
  SELECT o_orderkey AS "CallNumber", o_orderpriority AS "CallType", CAST(o_orderdate AS DATE) AS "CallDate",
         CAST(o_orderdate AS DATE) AS "WatchDate",
         o_orderdate + to_seconds(o_orderkey % 86400) AS "AvailableDtTm",
         n_name AS "Neighborhood", o_totalprice / 1000 AS "Delay"
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def raw_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as emergency calls, dates and times as text the way a CSV delivers them."""
    orders, customer, nation = (table(spark, sf_dir, n) for n in ("orders", "customer", "nation"))
    available = F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") % 86400)
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("CallNumber"),
            F.col("o_orderpriority").alias("CallType"),
            F.date_format("o_orderdate", "MM/dd/yyyy").alias("CallDate"),
            F.date_format("o_orderdate", "MM/dd/yyyy").alias("WatchDate"),
            F.date_format(available, "MM/dd/yyyy hh:mm:ss a").alias("AvailableDtTm"),
            F.col("n_name").alias("Neighborhood"),
            (F.col("o_totalprice") / 1000).alias("Delay"),
        )
    )


def typed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same calls as a typed table holds them, so that date predicates reach the scan."""
    orders, customer, nation = (table(spark, sf_dir, n) for n in ("orders", "customer", "nation"))
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("CallNumber"),
            F.col("o_orderpriority").alias("CallType"),
            F.col("o_orderdate").alias("CallDate"),
            F.col("n_name").alias("Neighborhood"),
            (F.col("o_totalprice") / 1000).alias("Delay"),
        )
    )


# --- course views -----------------------------------------------------------------------------

COURSES_SQL = """views AS (SELECT o_custkey AS user_id, l_partkey AS chapter_id
                           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
chapters AS (SELECT p_partkey AS chapter_id, p_brand AS course_id FROM part),
titles AS (SELECT DISTINCT p_brand AS course_id, 'Course ' || p_brand AS title FROM part)"""

SHARE_SQL = """per_course AS (SELECT course_id, count(*) AS chapters FROM chapters GROUP BY 1),
share AS (SELECT course_id, user_id, watched / chapters AS share
          FROM (SELECT user_id, course_id, count(*) AS watched FROM views JOIN chapters USING (chapter_id) GROUP BY 1, 2)
          JOIN per_course USING (course_id))"""


def course_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`views(user_id, chapter_id)`, `chapters(chapter_id, course_id)`, `titles(course_id, title)`."""
    lineitem, orders, part = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "part"))
    views = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("chapter_id")
    )
    chapters = part.select(F.col("p_partkey").alias("chapter_id"), F.col("p_brand").alias("course_id"))
    titles = part.select(
        F.col("p_brand").alias("course_id"), F.concat(F.lit("Course "), F.col("p_brand")).alias("title")
    ).distinct()
    return views, chapters, titles


# --- trips ------------------------------------------------------------------------------------

TRIPS_SQL = """trips AS (
  SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS id,
         CAST(l_suppkey % 2 + 1 AS DOUBLE) AS vendor_id,
         l_shipdate + to_seconds((l_orderkey * 37 + l_partkey * 11) % 86400) AS pickup_datetime,
         CAST(l_linenumber - 1 AS DOUBLE) AS passenger_count,
         -73.97 + ((l_partkey % 1000) - 500) / 1700.0e0 AS pickup_longitude,
         40.75 + ((l_suppkey % 100) - 50) / 320.0e0 AS pickup_latitude,
         -73.97 + ((l_orderkey % 997) - 498) / 1700.0e0 AS dropoff_longitude,
         40.75 + ((l_orderkey % 89) - 44) / 320.0e0 AS dropoff_latitude,
         CASE WHEN l_linestatus = 'O' THEN 'N' ELSE 'Y' END AS store_and_fwd_flag,
         60 + l_quantity * 20 + l_extendedprice / 100 AS trip_duration
  FROM lineitem),
distances AS (
  SELECT *, CAST(extract(hour FROM pickup_datetime) AS INTEGER) AS hour,
         CAST(extract(dow FROM pickup_datetime) + 1 AS INTEGER) AS day,
         2 * 6371 * 1.1e0 * atan2(sqrt(a), sqrt(1 - a)) AS distance
  FROM (SELECT *, pow(sin(radians(dropoff_latitude - pickup_latitude) / 2), 2)
               + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
               * pow(sin(radians(dropoff_longitude - pickup_longitude) / 2), 2) AS a FROM trips))"""


def trips(lineitem: DataFrame) -> DataFrame:
    """Order lines as taxi trips; coordinates and times by arithmetic on the keys."""
    second = ((F.col("l_orderkey") * 37 + F.col("l_partkey") * 11) % 86400)

    def degrees(centre: float, key: str, modulus: int, middle: int, scale: float):
        return F.lit(centre) + (F.col(key) % modulus - middle) / F.lit(scale)

    return lineitem.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])
        .alias("id"),
        (F.col("l_suppkey") % 2 + 1).cast("double").alias("vendor_id"),
        (F.col("l_shipdate") + F.make_dt_interval(secs=second)).alias("pickup_datetime"),
        (F.col("l_linenumber") - 1).cast("double").alias("passenger_count"),
        degrees(-73.97, "l_partkey", 1000, 500, 1700.0).alias("pickup_longitude"),
        degrees(40.75, "l_suppkey", 100, 50, 320.0).alias("pickup_latitude"),
        degrees(-73.97, "l_orderkey", 997, 498, 1700.0).alias("dropoff_longitude"),
        degrees(40.75, "l_orderkey", 89, 44, 320.0).alias("dropoff_latitude"),
        F.when(F.col("l_linestatus") == "O", "N").otherwise("Y").alias("store_and_fwd_flag"),
        (F.lit(60.0) + F.col("l_quantity") * 20 + F.col("l_extendedprice") / 100).alias("trip_duration"),
    )


# --- weather ----------------------------------------------------------------------------------

WEATHER_SQL = """weather AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 15, '0') || CAST(extract(year FROM o_orderdate) AS VARCHAR)
         || repeat('0', 68)
         || CASE WHEN o_orderkey % 97 = 0 THEN '+9999'
                 WHEN t < 0 THEN '-' || lpad(CAST(-t AS VARCHAR), 4, '0')
                 ELSE '+' || lpad(CAST(t AS VARCHAR), 4, '0') END
         || CAST(o_custkey % 10 AS VARCHAR) AS value
  FROM (SELECT *, (o_orderkey * 7919) % 1000 - 400 AS t FROM orders))"""


def weather_lines(orders: DataFrame) -> DataFrame:
    """Orders as fixed-width measurements, some missing and some of bad quality."""
    number = (F.col("o_orderkey") * 7919) % 1000 - 400
    digits = F.lpad(F.abs(number).cast("string"), 4, "0")
    reading = F.when(F.col("o_orderkey") % 97 == 0, "+9999").otherwise(
        F.concat(F.when(number < 0, "-").otherwise("+"), digits)
    )
    return orders.select(
        F.concat(
            F.lpad(F.col("o_orderkey").cast("string"), 15, "0"),
            F.year("o_orderdate").cast("string"),
            F.lit("0" * 68),
            reading,
            (F.col("o_custkey") % 10).cast("string"),
        ).alias("value")
    )


# --- card payments, messages, fires, games ------------------------------------------------------

# Fixed value: the length of the vectors in `embeddings`.
MEASURES = 64


def card_payments(embeddings: DataFrame) -> DataFrame:
    """`id, V1…V64, fraud`: a rare class over anonymous measures, one for each embedding value."""
    measures = [F.col("embedding")[n].cast("double").alias(f"V{n + 1}") for n in range(MEASURES)]
    return embeddings.select(
        F.col("vec_id").alias("id"), *measures, (F.col("label") == 0).cast("int").alias("fraud")
    )


def messages(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`id, text, target`: whole texts with a 0/1 class."""
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("id"), "text", F.col("quality").cast("double").alias("target")
    )


FIRE_COLUMNS = ["X", "Y", "month", "day", "FFMC", "DMC", "DC", "ISI", "temp", "RH", "wind", "rain", "area"]
FIRE_TYPES = {name: "double" for name in FIRE_COLUMNS[4:]}


def fire_strings(lineitem: DataFrame) -> DataFrame:
    """Order lines as forest-fire rows, all text; the rain column has entries that are no number."""
    text = {
        "X": F.col("l_linenumber"),
        "Y": F.col("l_suppkey") % 9,
        "month": F.month("l_shipdate"),
        "day": F.dayofmonth("l_shipdate"),
        "FFMC": F.col("l_quantity"),
        "DMC": F.col("l_partkey") % 291,
        "DC": F.col("l_orderkey") % 860,
        "ISI": F.col("l_tax") * 100,
        "temp": F.col("l_discount") * 300,
        "RH": F.col("l_suppkey") % 100,
        "wind": F.col("l_linenumber") * 1.5,
        "rain": F.when(F.col("l_partkey") % 50 == 0, F.lit("n/a")).otherwise((F.col("l_partkey") % 7).cast("string")),
        "area": F.col("l_extendedprice") / 100,
    }
    return lineitem.select(*[text[name].cast("string").alias(name) for name in FIRE_COLUMNS])


def games(orders: DataFrame) -> DataFrame:
    """Orders as timed board games: settings, winner side and duration in seconds."""
    return orders.select(
        F.col("o_orderkey").alias("game_id"),
        (F.col("o_custkey") % 20 * 60).cast("int").alias("initial_time_seconds"),
        (F.col("o_orderkey") % 10).cast("int").alias("increment_seconds"),
        (F.col("o_orderkey") % 4).cast("int").alias("max_overtime_minutes"),
        F.col("o_orderstatus").alias("winner"),
        (F.col("o_totalprice") / 500 + F.col("o_custkey") % 20 * 30).alias("game_duration_seconds"),
    )


def ratings(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders as rated games: player, score and rating."""
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("game_id"),
        F.col("c_name").alias("nickname"),
        (F.col("o_totalprice") / 1000).cast("int").alias("score"),
        (F.col("c_acctbal") / 10 + F.col("o_totalprice") / 2000).cast("int").alias("rating"),
    )
