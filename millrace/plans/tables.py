"""Queries for scans, sinks, columns, filters, table joins, aggregates, order and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars as X
from millrace.operators import order, reports, tables as O, text
from millrace.operators.order import exact_quantiles
from millrace.plans import views as V
from millrace.plans.catalog import query
from millrace.session import cut_lineage, new_folder
from millrace.sources import files

table = V.table

# --- scans and sinks --------------------------------------------------------------------------


@query(
    "s01_read_text",
    f"WITH {V.LINES_SQL} SELECT file AS source, count(*) AS n_lines FROM lines GROUP BY 1",
)
def s01(spark, sf_dir):
    path = new_folder(spark, "text")
    lines = V.text_lines(table(spark, sf_dir, "documents"))
    lines.withColumnRenamed("file", "source").write.partitionBy("source").text(path)
    # Each source is a folder of text files; the glob reads them all.
    read = files.read_text(spark, f"{path}/source=*")
    folder = F.substring_index(F.substring_index(F.input_file_name(), "source=", -1), "/", 1)
    return read.groupBy(folder.alias("source")).agg(F.count("*").alias("n_lines"))


SCALAR_ORDERS = "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate DATE"


def _orders_csv(spark, sf_dir, sep=","):
    path = new_folder(spark, "csv")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )
    orders.write.option("header", True).option("sep", sep).csv(path)
    return path


@query(
    "s02_read_csv",
    "SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
)
def s02(spark, sf_dir):
    return files.read_csv(spark, _orders_csv(spark, sf_dir), SCALAR_ORDERS, header=True)


@query(
    "s03_read_csv_inferred",
    "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def s03(spark, sf_dir):
    path = _orders_csv(spark, sf_dir, sep=";")
    read = files.read_csv_inferred(spark, path, sep=";", sampling=0.5)
    return read.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "s04_read_csv_strings_cast",
    """SELECT l_linenumber AS x, count(*) AS n, count(CASE WHEN l_partkey % 50 <> 0 THEN 1 END) AS n_rain,
              round(avg(CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_partkey % 7 AS DOUBLE) END), 6) AS avg_rain,
              round(max(l_extendedprice / 100), 4) AS max_area
       FROM lineitem GROUP BY 1""",
)
def s04(spark, sf_dir):
    path = new_folder(spark, "csv")
    files.write_csv(V.fire_strings(table(spark, sf_dir, "lineitem")), path, header=True)
    fires = files.cast_columns(
        files.read_csv_strings(spark, path, V.FIRE_COLUMNS), {**V.FIRE_TYPES, "X": "int"}
    )
    return fires.groupBy(F.col("X").alias("x")).agg(
        F.count("*").alias("n"),
        F.count("rain").alias("n_rain"),
        F.round(F.avg("rain"), 6).alias("avg_rain"),
        F.round(F.max("area"), 4).alias("max_area"),
    )


@query("s05_read_parquet", "SELECT p_partkey, p_brand, p_size FROM part")
def s05(spark, sf_dir):
    return files.read_parquet(spark, f"{sf_dir}/part.parquet").select("p_partkey", "p_brand", "p_size")


@query(
    "s06_from_rows",
    """SELECT s.name AS source_name, count(*) AS n FROM events
       JOIN (VALUES (0, 'web'), (1, 'e-mail'), (2, 'database'), (3, 'firewall'), (4, 'ml-model')) s(source, name)
         ON user_id % 5 = s.source GROUP BY 1""",
)
def s06(spark, sf_dir):
    names = source_lookup(spark).withColumnRenamed("source_string", "source_name")
    events = table(spark, sf_dir, "events").select((F.col("user_id") % 5).cast("int").alias("source"))
    return events.join(F.broadcast(names), "source").groupBy("source_name").agg(F.count("*").alias("n"))


def source_lookup(spark):
    """The five source systems, a table of fixed size."""
    return files.from_rows(spark, list(enumerate(V.SOURCES)), "source INT, source_string STRING")


@query("s07_write_parquet", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def s07(spark, sf_dir):
    chosen = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return files.write_parquet(chosen, new_folder(spark, "snapshot"))


@query(
    "s08_write_csv",
    "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1",
)
def s08(spark, sf_dir):
    path = new_folder(spark, "csv")
    report = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    files.write_csv(report, path, one_file=True)  # a report of a few segments
    return files.read_csv(spark, path, "c_mktsegment STRING, n BIGINT", header=False)


@query(
    "s09_write_kv_text",
    f"""WITH {V.LINES_SQL}, w AS (SELECT unnest(regexp_extract_all(value, '[^ \\t\\n\\r\\f]+')) AS word FROM lines)
        SELECT word || chr(9) || count(*) AS value FROM w GROUP BY word""",
)
def s09(spark, sf_dir):
    path = new_folder(spark, "text")
    counts = text.word_count(V.text_lines(table(spark, sf_dir, "documents")), tokenizer="whitespace")
    files.write_kv_text(counts, path, "word", "n")
    return files.read_text(spark, path)


@query(
    "s17_read_fixed_width",
    f"""WITH {V.WEATHER_SQL}
        SELECT substr(value, 16, 4) AS year, substr(value, 88, 5) AS temperature, substr(value, 93, 1) AS quality
        FROM weather""",
)
def s17(spark, sf_dir):
    return files.read_fixed_width(V.weather_lines(table(spark, sf_dir, "orders")), reports.WEATHER_FIELDS)


# --- columns and filters ----------------------------------------------------------------------


@query(
    "p01_with_column",
    """SELECT l_orderkey, l_linenumber, l_quantity * 2 AS l_quantity, l_quantity > 30 AS is_large FROM lineitem""",
)
def p01(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return lines.withColumn("is_large", F.col("l_quantity") > 30).withColumn("l_quantity", F.col("l_quantity") * 2)


@query("p02_select", "SELECT o_orderkey, o_orderstatus FROM orders")
def p02(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")


@query(
    "p03_expand_window",
    """SELECT event_id, time_bucket(INTERVAL 5 MINUTES, ts) AS start,
              time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES AS "end" FROM events""",
)
def p03(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .select("event_id", F.window("ts", "5 minutes").alias("window"))
        .select("event_id", "window.*")
    )


@query("p04_drop", "SELECT p_partkey, p_name FROM part")
def p04(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.drop("p_brand", "p_type").drop(parts.p_size).drop("p_retailprice")


@query("p05_rename", "SELECT n_nationkey AS nation_id, n_name AS nation FROM nation")
def p05(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "nation_id")
    return nation.select("nation_id", F.col("n_name").alias("nation"))


@query(
    "p06_sql_expression",
    "SELECT l_orderkey, l_partkey, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem",
)
def p06(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.expr("round(l_extendedprice * (1 - l_discount), 4) AS net")
    )


@query(
    "p07_cast",
    """SELECT event_id, CAST(value AS INTEGER) AS whole, CAST(event_id AS DOUBLE) AS as_double, ts AS as_time,
              event_type AS as_text FROM (SELECT event_id, floor(value) AS value, ts, event_type FROM events)""",
)
def p07(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id_text"),
        F.floor("value").cast("string").alias("value_text"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time_text"),
        F.col("event_type").cast("binary").alias("type_bytes"),
    )
    return raw.select(
        F.col("id_text").cast("bigint").alias("event_id"),
        F.col("value_text").try_cast("int").alias("whole"),
        F.col("id_text").try_cast("double").alias("as_double"),
        F.col("time_text").try_cast("timestamp_ntz").alias("as_time"),
        F.col("type_bytes").cast("string").alias("as_text"),
    )


@query("p08_equality", "SELECT p_partkey, p_size FROM part WHERE p_size = 15 AND p_brand = 'Brand#11'")
def p08(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.where((F.col("p_size") == 15) & (F.col("p_brand") == "Brand#11")).select("p_partkey", "p_size")


@query("p09_range", "SELECT event_id, value FROM events WHERE value BETWEEN 2.5 AND 40")
def p09(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return O.within(events, {"value": (2.5, 40.0)})


@query(
    "p10_like",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE (o_orderpriority LIKE '1%' OR o_orderpriority LIKE '%LOW') AND NOT o_orderpriority LIKE '??'""",
)
def p10(spark, sf_dir):
    priority = F.col("o_orderpriority")
    return (
        table(spark, sf_dir, "orders")
        .where((priority.like("1%") | priority.like("%LOW")) & ~priority.like("??"))
        .select("o_orderkey", "o_orderpriority")
    )


@query("p11_in_list", "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'purchase')")
def p11(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.where(F.col("event_type").isin("error", "purchase")).select("event_id", "event_type")


@query(
    "p12_drop_missing",
    """SELECT l_orderkey, l_linenumber, CAST(l_partkey % 7 AS DOUBLE) AS rain FROM lineitem WHERE l_partkey % 50 <> 0""",
)
def p12(spark, sf_dir):
    rain = F.when(F.col("l_partkey") % 50 == 0, F.lit("n/a")).otherwise((F.col("l_partkey") % 7).cast("string"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", rain.alias("rain"))
    return O.drop_missing(files.cast_columns(lines, {"rain": "double"}))


@query(
    "p13_sentinel_quality",
    f"""WITH {V.WEATHER_SQL}, f AS (
          SELECT substr(value, 16, 4) AS year, CAST(substr(value, 88, 5) AS INTEGER) AS temperature,
                 substr(value, 93, 1) AS quality FROM weather)
        SELECT * FROM f WHERE temperature <> 9999 AND quality IN ('0', '1', '4', '5', '9')""",
)
def p13(spark, sf_dir):
    fields = reports.parse_weather(V.weather_lines(table(spark, sf_dir, "orders")))
    return O.valid_measurements(fields, "temperature", "quality")


# The area trips must start and end in.
TRIP_BOX = {
    "pickup_longitude": (-74.25, -73.7),
    "dropoff_longitude": (-74.25, -73.7),
    "pickup_latitude": (40.6, 40.9),
    "dropoff_latitude": (40.6, 40.9),
}
BOX_SQL = """pickup_longitude BETWEEN -74.25 AND -73.7 AND dropoff_longitude BETWEEN -74.25 AND -73.7
  AND pickup_latitude BETWEEN 40.6 AND 40.9 AND dropoff_latitude BETWEEN 40.6 AND 40.9"""


@query("p14_bounding_box", f"WITH {V.TRIPS_SQL} SELECT id, passenger_count FROM trips WHERE {BOX_SQL}")
def p14(spark, sf_dir):
    return O.within(V.trips(table(spark, sf_dir, "lineitem")), TRIP_BOX).select("id", "passenger_count")


@query(
    "p15_prefix_columns",
    "SELECT "
    + ", ".join(f"round(CAST(embedding[{n}] AS DOUBLE), 6) AS V{n}" for n in range(1, V.MEASURES + 1))
    + " FROM embeddings",
)
def p15(spark, sf_dir):
    payments = V.card_payments(table(spark, sf_dir, "embeddings"))
    return payments.select(*[F.round(name, 6).alias(name) for name in O.columns_with_prefix(payments, "V")])


# --- joins of tables --------------------------------------------------------------------------


@query(
    "j01_inner_join",
    f"WITH {V.COURSES_SQL} SELECT chapter_id, user_id, course_id FROM views JOIN chapters USING (chapter_id)",
)
def j01(spark, sf_dir):
    seen, chapters, _ = V.course_tables(spark, sf_dir)
    return seen.join(chapters, "chapter_id").select("chapter_id", "user_id", "course_id")


@query(
    "j02_chained_joins",
    f"""WITH {V.COURSES_SQL}, {V.SHARE_SQL}
        SELECT course_id, user_id, round(share, 9) AS share, title FROM share JOIN titles USING (course_id)""",
)
def j02(spark, sf_dir):
    seen, chapters, titles = V.course_tables(spark, sf_dir)
    return (
        reports.view_share(seen, chapters)
        .join(titles, "course_id")
        .select("course_id", "user_id", F.round("share", 9).alias("share"), "title")
    )


@query(
    "j03_lookup_drop_key",
    """SELECT event_id, CASE user_id % 5 WHEN 0 THEN 'web' WHEN 1 THEN 'e-mail' WHEN 2 THEN 'database'
              WHEN 3 THEN 'firewall' ELSE 'ml-model' END AS source_string FROM events""",
)
def j03(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 5).cast("int").alias("source"))
    # Five rows by construction, hence safe to broadcast.
    return O.lookup(events, F.broadcast(source_lookup(spark)), "source")


# --- aggregates -------------------------------------------------------------------------------

SPACE_SQL = f"WITH {V.LINES_SQL}, w AS (SELECT unnest(string_split(value, ' ')) AS word, file FROM lines)"
BLANK_SQL = (
    f"WITH {V.LINES_SQL}, w AS (SELECT unnest(regexp_extract_all(value, '[^ \\t\\n\\r\\f]+')) AS word, file FROM lines)"
)
LOWER_SQL = f"WITH {V.LINES_SQL}, w AS (SELECT unnest(string_split(lower(value), ' ')) AS word, file FROM lines)"
LOWER_BLANK_SQL = (
    f"WITH {V.LINES_SQL}, w AS (SELECT unnest(regexp_extract_all(lower(value), '[^ \\t\\n\\r\\f]+')) AS word, file FROM lines)"
)


@query("a01_word_count_space", f"{SPACE_SQL} SELECT word, count(*) AS n FROM w GROUP BY 1")
def a01(spark, sf_dir):
    return text.word_count(V.text_lines(table(spark, sf_dir, "documents")))


@query("a02_word_count_whitespace", f"{BLANK_SQL} SELECT word, count(*) AS n FROM w GROUP BY 1")
def a02(spark, sf_dir):
    return text.word_count(V.text_lines(table(spark, sf_dir, "documents")), tokenizer="whitespace")


@query("a03_index_pairs", f"{SPACE_SQL} SELECT word, file, count(*) AS n FROM w GROUP BY 1, 2")
def a03(spark, sf_dir):
    return text.inverted_index(V.text_lines(table(spark, sf_dir, "documents")))


@query(
    "a04_index_set",
    f"""{LOWER_SQL} SELECT word, 0 AS block, count(*) AS n, string_agg(DISTINCT file, ';' ORDER BY file) AS files
        FROM w GROUP BY 1""",
)
def a04(spark, sf_dir):
    index = document_index(spark, sf_dir, form="set", lower=True)
    return index.withColumn("files", F.array_join("files", ";"))


def document_index(spark, sf_dir, **settings):
    """Index over the lines of all documents. The sources are few, so each word is one block."""
    return text.inverted_index(V.text_lines(table(spark, sf_dir, "documents")), **settings)


@query(
    "a05_index_postings",
    f"""{LOWER_BLANK_SQL} SELECT word, 0 AS block, string_agg(file || ':' || n, ';' ORDER BY file) AS postings
        FROM (SELECT word, file, count(*) AS n FROM w GROUP BY 1, 2) GROUP BY 1""",
)
def a05(spark, sf_dir):
    return document_index(spark, sf_dir, form="postings", tokenizer="whitespace", lower=True).drop("n")


@query("a06_max_per_key", "SELECT l_suppkey, max(l_extendedprice) AS max_price FROM lineitem GROUP BY 1")
def a06(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.max("l_extendedprice").alias("max_price"))


@query(
    "a07_min_max_avg",
    """SELECT l_returnflag, l_linestatus, max(l_quantity) AS max_qty, min(l_quantity) AS min_qty,
              round(avg(l_quantity), 6) AS avg_qty FROM lineitem GROUP BY 1, 2""",
)
def a07(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.max("l_quantity").alias("max_qty"),
        F.min("l_quantity").alias("min_qty"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
    )


@query(
    "a08_count_column",
    """SELECT l_linenumber, count(*) AS n_all, count(CASE WHEN l_partkey % 50 <> 0 THEN l_partkey END) AS n_known
       FROM lineitem GROUP BY 1""",
)
def a08(spark, sf_dir):
    known = F.when(F.col("l_partkey") % 50 != 0, F.col("l_partkey"))
    return table(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(
        F.count("*").alias("n_all"), F.count(known).alias("n_known")
    )


@query("a09_group_count", 'SELECT o_orderstatus, count(*) AS "count" FROM orders GROUP BY 1')
def a09(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").count()


@query(
    "a10_mean_sum",
    """SELECT c_nationkey, round(avg(c_acctbal), 4) AS mean_balance, round(sum(c_acctbal), 2) AS total_balance
       FROM customer GROUP BY 1""",
)
def a10(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.round(F.mean("c_acctbal"), 4).alias("mean_balance"),
        F.round(F.sum("c_acctbal"), 2).alias("total_balance"),
    )


@query(
    "a11_group_by_expression",
    """SELECT CAST(extract(month FROM o_orderdate) AS INTEGER) AS month,
              CAST(extract(week FROM o_orderdate) AS INTEGER) AS week, count(*) AS n FROM orders GROUP BY 1, 2""",
)
def a11(spark, sf_dir):
    date = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").groupBy(
        F.month(date).alias("month"), F.weekofyear(date).alias("week")
    ).agg(F.count("*").alias("n"))


@query(
    "a12_distinct_values",
    """SELECT DISTINCT o_orderpriority AS "CallType" FROM orders
       WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""",
)
def a12(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("CallType"), F.col("o_orderdate").alias("CallDate")
    )
    return reports.call_types(orders, 1998)


@query(
    "a13_conditional_sums",
    """SELECT user_id, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS click,
              CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS error FROM events GROUP BY 1""",
)
def a13(spark, sf_dir):
    return reports.pivot_sums(table(spark, sf_dir, "events"), "event_type", ["click", "error"], ["user_id"])


@query(
    "a14_group_ratio",
    f"WITH {V.COURSES_SQL}, {V.SHARE_SQL} SELECT course_id, user_id, round(share, 9) AS share FROM share",
)
def a14(spark, sf_dir):
    seen, chapters, _ = V.course_tables(spark, sf_dir)
    return reports.view_share(seen, chapters).select("course_id", "user_id", F.round("share", 9).alias("share"))


@query(
    "a15_deviation_bounds",
    """WITH b AS (SELECT avg(l_extendedprice) - stddev_samp(l_extendedprice) AS lo,
                         avg(l_extendedprice) + stddev_samp(l_extendedprice) AS hi FROM lineitem)
       SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem, b WHERE l_extendedprice BETWEEN lo AND hi""",
)
def a15(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    return O.drop_outliers(lines, "l_extendedprice")


@query(
    "a16_error_bands",
    """SELECT CASE WHEN m <= 50 THEN '0-50' WHEN m <= 200 THEN '50-200' WHEN m <= 500 THEN '200-500'
                   WHEN m <= 5000 THEN '500-5000' ELSE '5000+' END AS range, count(*) AS n
       FROM (SELECT abs(l_quantity * 1500 - l_extendedprice) AS m FROM lineitem) GROUP BY 1""",
)
def a16(spark, sf_dir):
    guessed = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") * 1500).alias("prediction")
    )
    return O.error_bands(guessed, "l_extendedprice")


@query(
    "a18_count_filtered",
    """SELECT count(*) AS n_all, count(CASE WHEN o_totalprice > 200000 THEN 1 END) AS n_large FROM orders""",
)
def a18(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(
        F.count("*").alias("n_all"), F.count_if(F.col("o_totalprice") > 200000).alias("n_large")
    )


@query(
    "a19_quartiles",
    """WITH r AS (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) AS i,
                         count(*) OVER () AS n FROM lineitem)
       SELECT min(CASE WHEN i >= ceil(n * 0.25) THEN v END) AS q0, min(CASE WHEN i >= ceil(n * 0.5) THEN v END) AS q1,
              min(CASE WHEN i >= ceil(n * 0.75) THEN v END) AS q2 FROM r""",
)
def a19(spark, sf_dir):
    return exact_quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", [0.25, 0.5, 0.75])


@query(
    "a19_quantile_sketch",
    """SELECT year, count(*) AS n, share, true AS within
       FROM (SELECT CAST(extract(year FROM l_shipdate) AS INTEGER) AS year FROM lineitem),
            (VALUES (0.05e0), (0.25e0), (0.5e0), (0.75e0), (0.95e0)) v(share) GROUP BY year, share""",
)
def a19_sketch(spark, sf_dir):
    # One sketch a day, merged to years; the true rank of each quantile is within the stated error.
    lines = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day"), F.col("l_extendedprice").alias("price"))
    days = cut_lineage(order.quantile_sketches(lines, ["day"], "price"))
    found = cut_lineage(order.sketched_quantiles(days.withColumn("year", F.year("day")), [0.05, 0.25, 0.5, 0.75, 0.95], ["year"]))
    ranked = lines.join(F.broadcast(found), F.year("day") == F.col("year"))  # five rows a year
    below, upto = F.count_if(F.col("price") < F.col("value")), F.count_if(F.col("price") <= F.col("value"))
    error = F.lit(order.rank_error())
    return ranked.groupBy("year", "n", "share").agg(
        ((below / F.count("*") <= F.col("share") + error) & (upto / F.count("*") >= F.col("share") - error)).alias("within")
    )


@query(
    "a20_count_per_category",
    """SELECT CASE WHEN value / 10 >= 3.25 THEN 'HIGH' WHEN value / 10 >= 3.1 THEN 'MEDIUM' ELSE 'LOW' END AS category,
              count(*) AS n FROM events GROUP BY 1""",
)
def a20(spark, sf_dir):
    acid = table(spark, sf_dir, "events").select((F.col("value") / 10).alias("ph"))
    category = X.score_bands("ph", X.ACIDITY_BANDS, "LOW")
    return acid.groupBy(category.alias("category")).agg(F.count("*").alias("n"))


# --- order, limits, set operations ------------------------------------------------------------


@query("o01_order_descending", f"{SPACE_SQL} SELECT word, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, word")
def o01(spark, sf_dir):
    return text.word_count(V.text_lines(table(spark, sf_dir, "documents"))).orderBy(F.desc("n"), "word")


@query(
    "o02_order_by_two_keys",
    "SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2 ORDER BY 1, 3 DESC",
)
def o02(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"))
    return counts.orderBy("l_suppkey", F.desc("n"), "l_returnflag")


@query(
    "o03_top_group",
    "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 1",
)
def o03(spark, sf_dir):
    return O.top_group(table(spark, sf_dir, "lineitem"), "l_suppkey", F.count("*"), "l_suppkey", "n")


@query(
    "o04_busiest_week",
    f"""WITH {V.CALLS_SQL} SELECT CAST(extract(week FROM "CallDate") AS INTEGER) AS week, count(*) AS "count" FROM calls
        WHERE extract(year FROM "CallDate") = 1998 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
)
def o04(spark, sf_dir):
    calls = V.typed_calls(spark, sf_dir)
    return reports.calls_by(calls, F.weekofyear("CallDate"), 1998, "week", top=True)


@query("o05_random_order", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey || '|42'), o_orderkey")
def o05(spark, sf_dir):
    return O.shuffled(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


@query(
    "u01_union",
    """SELECT c_custkey AS party, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal FROM supplier""",
)
def u01(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("party"), F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("party"))
    return customers.unionByName(suppliers)


@query("u02_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def u02(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
