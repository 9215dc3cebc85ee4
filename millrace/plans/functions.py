"""Queries for scalar functions and functions called by name."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import named, scalars as X
from millrace.operators import reports, text
from millrace.plans import views as V
from millrace.plans.catalog import query
from millrace.sources import files

table = V.table


@query(
    "f01_split",
    """SELECT conv_id, turn, len(string_split(text, ' ')) AS n_space, len(regexp_split_to_array(text, '\\s')) AS n_blank,
              len(regexp_split_to_array(text, '\\W')) AS n_nonword FROM conversations""",
)
def f01(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.size(text.words("text")).alias("n_space"),
        F.size(text.words("text", "\\s")).alias("n_blank"),
        F.size(text.words("text", "\\W")).alias("n_nonword"),
    ).withColumns({c: F.col(c).cast("bigint") for c in ("n_space", "n_blank", "n_nonword")})


@query("f02_explode", "SELECT item_id, unnest(string_split(text, ' ')) AS word FROM benchmark")
def f02(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.split("text", " ")).alias("word"))


@query(
    "f03_element_at",
    """SELECT doc_id, string_split(text, ' ')[1] AS first_word, string_split(text, ' ')[40] AS word_40 FROM documents""",
)
def f03(spark, sf_dir):
    parts = F.split("text", " ")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.try_element_at(parts, F.lit(1)).alias("first_word"),
        F.try_element_at(parts, F.lit(40)).alias("word_40"),
    )


@query("f04_lower", "SELECT conv_id, turn, lower(text) AS text FROM conversations")
def f04(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lower("text").alias("text"))


@query(
    "f05_concat",
    """SELECT c_custkey, c_name || ' / ' || c_mktsegment AS joined, concat_ws('-', c_mktsegment, c_name) AS dashed
       FROM customer""",
)
def f05(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.col("c_name"), F.lit(" / "), F.col("c_mktsegment")).alias("joined"),
        F.concat_ws("-", "c_mktsegment", "c_name").alias("dashed"),
    )


@query(
    "f06_signed_number",
    f"""WITH {V.WEATHER_SQL} SELECT substr(value, 1, 15) AS station, CAST(substr(value, 88, 5) AS INTEGER) AS temperature
        FROM weather""",
)
def f06(spark, sf_dir):
    fields = files.read_fixed_width(
        V.weather_lines(table(spark, sf_dir, "orders")), {"station": (0, 15), "temperature": (87, 92)}
    )
    return fields.withColumn("temperature", X.signed_number("temperature"))


@query(
    "f07_strip_digits",
    "SELECT doc_id, md5(regexp_replace(text, '[0-9]+', '', 'g')) AS digest, "
    "length(regexp_replace(text, '[0-9]+', '', 'g')) AS n FROM documents",
)
def f07(spark, sf_dir):
    bare = F.regexp_replace("text", "\\d+", "")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(bare.cast("binary")).alias("digest"), F.length(bare).cast("bigint").alias("n")
    )


@query(
    "f08_full_match",
    """SELECT o_orderkey, regexp_full_match(CAST(o_custkey % 10 AS VARCHAR), '[01459]') AS good FROM orders""",
)
def f08(spark, sf_dir):
    code = (F.col("o_custkey") % 10).cast("string")
    return table(spark, sf_dir, "orders").select("o_orderkey", code.rlike("^[01459]$").alias("good"))


@query("f09_basename", "SELECT page_id, regexp_extract(url, '[^/]*$') AS name FROM pages")
def f09(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.basename("url").alias("name"))


@query("f10_source_file", "SELECT 'events.parquet' AS file, count(*) AS n FROM events")
def f10(spark, sf_dir):
    # A table kept as a folder has part files; its own name is then the folder's.
    events = table(spark, sf_dir, "events").select(F.col("_metadata.file_path").alias("path"))
    name = F.regexp_extract("path", "([^/]*\\.parquet)(/[^/]*)?$", 1)
    return events.groupBy(name.alias("file")).agg(F.count("*").alias("n"))


@query("f11_to_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS call_date FROM orders")
def f11(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("d"))
    return raw.select("o_orderkey", X.us_date("d").alias("call_date"))


@query(
    "f12_to_timestamp",
    "SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS available FROM orders",
)
def f12(spark, sf_dir):
    moment = F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") % 86400)
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(moment, "MM/dd/yyyy hh:mm:ss a").alias("t")
    )
    return raw.select("o_orderkey", X.us_timestamp("t").cast("timestamp_ntz").alias("available"))


@query(
    "f13_string_to_timestamp",
    "SELECT event_id, ts AS event_time, CAST(NULL AS TIMESTAMP) AS broken FROM events",
)
def f13(spark, sf_dir):
    # Digits past microseconds are cut off; text that is no time becomes null.
    raw = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("789")).alias("t")
    )
    return raw.select(
        "event_id",
        F.col("t").try_cast("timestamp_ntz").alias("event_time"),
        F.concat(F.col("t"), F.lit(" o'clock")).try_cast("timestamp_ntz").alias("broken"),
    )


@query(
    "f14_year_month_week",
    """SELECT o_orderkey, CAST(extract(year FROM o_orderdate) AS INTEGER) AS y,
              CAST(extract(month FROM o_orderdate) AS INTEGER) AS m, CAST(extract(week FROM o_orderdate) AS INTEGER) AS w
       FROM orders""",
)
def f14(spark, sf_dir):
    date = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(date).alias("y"), F.month(date).alias("m"), F.weekofyear(date).alias("w")
    )


@query(
    "f15_hour_dayofweek",
    """SELECT event_id, CAST(extract(hour FROM ts) AS INTEGER) AS hour,
              CAST(extract(dow FROM ts) + 1 AS INTEGER) AS day FROM events""",
)
def f15(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.hour("ts").alias("hour"), F.dayofweek("ts").alias("day")
    )


@query(
    "f16_bround",
    """SELECT event_id, CAST(round_even(event_id / 2, 0) AS DOUBLE) AS halves,
              CAST(round_even(event_id / 8, 2) AS DOUBLE) AS eighths FROM events""",
)
def f16(spark, sf_dir):
    # Halves and eighths are exact in binary, so every tie is a real one.
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.bround(F.col("event_id") / 2, 0).alias("halves"),
        F.bround(F.col("event_id") / 8, 2).alias("eighths"),
    )


@query(
    "f17_arithmetic",
    """SELECT l_orderkey, l_partkey, l_linenumber, abs(l_quantity - 25) AS margin,
              l_quantity / nullif(l_linenumber - 1, 0) AS ratio FROM lineitem""",
)
def f17(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.abs(F.col("l_quantity") - 25).alias("margin"),
        F.try_divide("l_quantity", F.col("l_linenumber") - 1).alias("ratio"),
    )


@query(
    "f18_when_bands",
    """SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END AS band
       FROM part""",
)
def f18(spark, sf_dir):
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.when(size <= 10, "small").when(size <= 30, "medium").otherwise("large").alias("band")
    )


@query("f19_rand", "SELECT count(*) AS n, true AS in_range, true AS centred FROM orders")
def f19(spark, sf_dir):
    # Draws differ from run to run of a cluster; their range and their mean (five deviations) do not.
    draws = table(spark, sf_dir, "orders").select(F.rand(42).alias("draw"))
    return draws.agg(
        F.count("*").alias("n"),
        F.bool_and((F.col("draw") >= 0) & (F.col("draw") < 1)).alias("in_range"),
        (F.abs(F.avg("draw") - 0.5) < 5 / F.sqrt(12 * F.count("*"))).alias("centred"),
    )


@query(
    "f20_great_circle",
    f"""WITH {V.TRIPS_SQL} SELECT id, round(distance, 6) AS distance,
            round(atan2(dropoff_latitude - pickup_latitude, dropoff_longitude - pickup_longitude), 6) AS direction
        FROM distances""",
)
def f20(spark, sf_dir):
    north = F.col("dropoff_latitude") - F.col("pickup_latitude")
    east = F.col("dropoff_longitude") - F.col("pickup_longitude")
    return V.trips(table(spark, sf_dir, "lineitem")).select(
        "id", F.round(trip_distance(), 6).alias("distance"), F.round(F.atan2(north, east), 6).alias("direction")
    )


def trip_distance():
    return X.haversine("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


@query("f21_logarithm", "SELECT event_id, round(ln(1 + value), 9) AS l1, round(ln(value + 2), 9) AS l2 FROM events")
def f21(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(F.log1p("value"), 9).alias("l1"), F.round(F.log(F.col("value") + 2), 9).alias("l2")
    )


@query(
    "f22_event_time_bucket",
    """SELECT event_id, b - s * INTERVAL 5 MINUTES AS start, b - s * INTERVAL 5 MINUTES + INTERVAL 10 MINUTES AS "end"
       FROM (SELECT event_id, time_bucket(INTERVAL 5 MINUTES, ts) AS b FROM events), (VALUES (0), (1)) v(s)""",
)
def f22(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.window("ts", "10 minutes", "5 minutes").alias("w")).select("event_id", "w.*")


# --- functions called by name -------------------------------------------------------------------


@query(
    "g01_call_by_name",
    """SELECT regexp_extract(url, '[^/]*$') AS name, count(*) AS n FROM pages GROUP BY 1""",
)
def g01(spark, sf_dir):
    named.register_all(spark)
    pages = table(spark, sf_dir, "pages")
    return pages.groupBy(F.call_udf("file_basename", F.col("url")).alias("name")).agg(F.count("*").alias("n"))


@query(
    "g02_score_bands",
    f"""WITH {V.COURSES_SQL}, {V.SHARE_SQL}
        SELECT course_id, user_id, CASE WHEN share * 20 >= 0.9 THEN 10 WHEN share * 20 >= 0.5 THEN 4
               WHEN share * 20 >= 0.25 THEN 2 ELSE 0 END AS score FROM share""",
)
def g02(spark, sf_dir):
    # Shares in these tables are small, so they are stretched to reach every band.
    named.register_all(spark)
    seen, chapters, _ = V.course_tables(spark, sf_dir)
    score = F.call_udf("view_score", F.col("share") * 20)
    return reports.view_share(seen, chapters).select("course_id", "user_id", score.alias("score"))


@query(
    "g03_score_ranking",
    f"""WITH {V.COURSES_SQL}, {V.SHARE_SQL}
        SELECT course_id, CAST(sum(CASE WHEN share > 0.9 THEN 10 WHEN share > 0.5 THEN 6 WHEN share > 0.25 THEN 2
               ELSE 0 END) AS BIGINT) AS total, title FROM share JOIN titles USING (course_id) GROUP BY 1, 3""",
)
def g03(spark, sf_dir):
    seen, chapters, titles = V.course_tables(spark, sf_dir)
    return reports.course_ranking(seen, chapters, titles)


@query(
    "g04_speed",
    f"WITH {V.TRIPS_SQL} SELECT id, round(distance / (trip_duration / 3600), 6) AS speed FROM distances",
)
def g04(spark, sf_dir):
    trips = V.trips(table(spark, sf_dir, "lineitem"))
    return trips.select("id", F.round(X.speed(trip_distance(), "trip_duration"), 6).alias("speed"))


@query(
    "g05_haversine_by_name",
    f"""WITH {V.TRIPS_SQL} SELECT vendor_id, count(*) AS n, round(sum(distance), 3) AS total FROM distances GROUP BY 1""",
)
def g05(spark, sf_dir):
    named.register_all(spark)
    corners = [F.col(c) for c in ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")]
    trips = V.trips(table(spark, sf_dir, "lineitem"))
    total = F.sum(F.call_udf("route_distance", *corners))
    return trips.groupBy("vendor_id").agg(F.count("*").alias("n"), F.round(total, 3).alias("total"))


@query(
    "g06_acidity_category",
    """SELECT event_id, CASE WHEN value / 10 >= 3.25 THEN 'HIGH' WHEN value / 10 >= 3.1 THEN 'MEDIUM' ELSE 'LOW' END
              AS category FROM events""",
)
def g06(spark, sf_dir):
    named.register_all(spark)
    category = F.call_udf("acidity_category", F.col("value") / 10)
    return table(spark, sf_dir, "events").select("event_id", category.alias("category"))
