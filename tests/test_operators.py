import random
from datetime import datetime

from pyspark.sql import functions as F

from millrace.functions import named, scalars as X
from millrace.operators import logs, order, reports, tables as O, text
from millrace.plans.tables import source_lookup

LINES = ["Dit is een tekst.", "Dit is géén grap.", "Phantom Dust forever."]
FUTURE = ["hallo", "dit ben ik", "uit de toekomst", "ik hoop dat je mij kan horen"]


def both_files(spark):
    rows = [("textfile.txt", line) for line in LINES] + [("future.txt", line) for line in FUTURE]
    return spark.createDataFrame(rows, "file STRING, value STRING")


def test_word_counts(spark, rows):
    counts = dict(rows(text.word_count(both_files(spark).where("file = 'textfile.txt'"))))
    assert counts["Dit"] == 2 and counts["is"] == 2 and len(counts) == 9
    gaps = spark.createDataFrame([("a  b\t\tA ",)], "value STRING")
    assert dict(rows(text.word_count(gaps))) == {"a": 1, "": 2, "b\t\tA": 1}
    assert dict(rows(text.word_count(gaps, tokenizer="whitespace"))) == {"a": 1, "b": 1, "A": 1}
    assert dict(rows(text.word_count(gaps, tokenizer="whitespace", lower=True))) == {"a": 2, "b": 1}


def test_inverted_index_forms(spark):
    lines = both_files(spark)
    pairs = {tuple(r) for r in text.inverted_index(lines).collect()}
    assert ("Dit", "textfile.txt", 2) in pairs and ("dit", "future.txt", 1) in pairs
    sets = {r["word"]: (r["n"], r["files"]) for r in text.inverted_index(lines, form="set", lower=True).collect()}
    assert sets["dit"] == (3, ["future.txt", "textfile.txt"])
    postings = text.inverted_index(lines, form="postings", tokenizer="whitespace", lower=True)
    assert postings.where("word = 'dit'").first()["postings"] == "future.txt:1;textfile.txt:2"


def test_index_blocks_keep_every_entry(spark):
    lines = spark.createDataFrame(
        [(f"f{n:03d}", "same") for n in range(200)] + [("f007", "rare")], "file STRING, value STRING"
    )
    index = text.inverted_index(lines, form="postings", files_per_row=20)
    blocks = index.where("word = 'same'").orderBy("block").collect()
    assert [r["block"] for r in blocks] == list(range(10)) and {r["n"] for r in blocks} == {200}
    # Blocks are ranges of the sorted files.
    assert ";".join(r["postings"] for r in blocks) == ";".join(f"f{n:03d}:1" for n in range(200))
    assert [tuple(r) for r in index.where("word = 'rare'").collect()] == [("rare", 0, 1, "f007:1")]
    assert index.schema == text.inverted_index(lines, form="postings").schema
    listed = text.inverted_index(lines, form="set", files_per_row=20).where("word = 'same'").orderBy("block").collect()
    assert [f for r in listed for f in r["files"]] == [f"f{n:03d}" for n in range(200)]


def test_max_per_year_skips_missing_and_bad_quality(spark, rows):
    def line(year, reading, quality):
        return "0" * 15 + year + "0" * 68 + reading + quality

    given = [
        line("1950", "+0022", "1"), line("1950", "-0011", "1"), line("1950", "+9999", "1"),
        line("1950", "+0500", "2"), line("1949", "-0111", "4"), line("1949", "-0078", "9"),
    ]
    frame = spark.createDataFrame([(g,) for g in given], "value STRING")
    assert rows(reports.max_by_year(frame)) == [("1949", -78), ("1950", 22)]


def course_fixture(spark):
    titles = [(1, "Test 123"), (2, "Tweede test 132"), (3, "Derde test 134")]
    views = [(14, 96), (14, 97), (13, 96), (13, 96), (13, 96), (14, 99), (13, 100)]
    chapters = [(96, 1), (97, 1), (98, 1), (99, 2)] + [(n, 3) for n in range(100, 110)]
    return (
        spark.createDataFrame(views, "user_id INT, chapter_id INT"),
        spark.createDataFrame(chapters, "chapter_id INT, course_id INT"),
        spark.createDataFrame(titles, "course_id INT, title STRING"),
    )


def test_viewing_report(spark, rows):
    views, chapters, titles = course_fixture(spark)
    assert rows(reports.viewing_report(views, chapters, titles, 13)) == [(1, "Test 123", 10), (3, "Derde test 134", 0)]
    assert rows(reports.viewing_report(views, chapters, titles, 14)) == [(1, "Test 123", 4), (2, "Tweede test 132", 10)]
    once = reports.viewing_report(views, chapters, titles, 13, distinct_views=True)
    assert rows(once) == [(1, "Test 123", 2), (3, "Derde test 134", 0)]
    ranking = [tuple(r) for r in reports.course_ranking(views, chapters, titles).collect()]
    assert ranking == [(1, 16, "Test 123"), (2, 10, "Tweede test 132"), (3, 0, "Derde test 134")]


def test_average_per_name(spark, rows):
    people = spark.createDataFrame(
        [("Brooke", 20), ("Brooke", 25), ("Denny", 31), ("Jules", 30), ("TD", 35)], "name STRING, age INT"
    )
    assert dict(rows(people.groupBy("name").agg(F.avg("age"))))["Brooke"] == 22.5


def test_named_functions_agree_with_columns(spark):
    named.register_all(spark)
    row = spark.sql(
        "SELECT file_basename('a/b/c.txt') f, view_score(0.9D) s, view_score_strict(0.9D) t, "
        "acidity_category(3.1D) c, route_speed(10D, 0D) v, route_distance(40.7D, -74D, 40.8D, -73.9D) d"
    ).first()
    assert tuple(row)[:5] == ("c.txt", 10, 6, "MEDIUM", None)
    point = spark.range(1).select(X.haversine(F.lit(40.7), F.lit(-74.0), F.lit(40.8), F.lit(-73.9)).alias("d")).first()
    assert abs(point["d"] - row["d"]) < 1e-9 and 15 < row["d"] < 16


def test_user_function_over_series(spark, rows):
    named.register_vectorised(spark, "twice", lambda s: s * 2, "bigint")
    assert rows(spark.range(3).select(F.call_udf("twice", "id"))) == [(0,), (2,), (4,)]


def test_bands_and_error_histogram(spark, rows):
    frame = spark.createDataFrame([(0.0, float(m)) for m in (50, 51, 200, 500, 5000, 5001)], "y DOUBLE, prediction DOUBLE")
    assert rows(O.error_bands(frame, "y")) == [
        ("0-50", 1), ("200-500", 1), ("50-200", 2), ("500-5000", 1), ("5000+", 1)
    ]
    assert [tuple(r) for r in spark.range(1).select(
        X.signed_number(F.lit("+0012")), X.signed_number(F.lit("-0012")), X.signed_number(F.lit("12x"))
    ).collect()] == [(12, -12, None)]


def test_log_lines_short_or_broken(spark, rows):
    lines = spark.createDataFrame(
        [("ERROR web 2022-12-01 10:00:00.123456789 This is message 1",), ("WARN",), ("INFO web no time at",)],
        "value STRING",
    )
    parsed = {r["level"]: r for r in logs.parse_log(lines).collect()}
    assert parsed["ERROR"]["event_time"] == datetime(2022, 12, 1, 10, 0, 0, 123456)
    assert parsed["WARN"]["source"] is None and parsed["INFO"]["event_time"] is None


def test_sliding_window_counts_each_event_twice(spark, rows):
    frame = spark.createDataFrame([("2022-12-01 10:07:00", "web")], "t STRING, source STRING").select(
        F.col("t").cast("timestamp").alias("event_time"), "source"
    )
    windows = rows(logs.plain_times(logs.windowed_counts(frame, "10 minutes", "5 minutes", ["source"]), "start", "end"))
    assert [(w[0].minute, w[1].minute) for w in windows] == [(0, 10), (5, 15)]


def test_source_lookup(spark, rows):
    assert rows(source_lookup(spark)) == [(0, "web"), (1, "e-mail"), (2, "database"), (3, "firewall"), (4, "ml-model")]


def skewed(count, seed):
    """Values of which every third is the same."""
    draw = random.Random(seed)
    return [7 if n % 3 == 0 else draw.randrange(1000) for n in range(count)]


def test_quantiles_and_ranks_against_brute_force(spark):
    values = skewed(997, 1)
    frame = spark.createDataFrame([(v,) for v in values], "v INT").repartition(5)
    ordered = sorted(values)
    got = order.exact_quantiles(frame, "v", [0.0, 0.25, 0.5, 0.9, 1.0]).first()
    wanted = [ordered[max(1, -(-len(ordered) * p // 100)) - 1] for p in (0, 25, 50, 90, 100)]
    assert list(got) == wanted
    ranks = {r["value"]: r["rank"] for r in order.average_ranks(frame, ["v"]).collect()}
    for value in set(values):
        places = [n + 1 for n, v in enumerate(ordered) if v == value]
        assert ranks[value] == sum(places) / len(places)


def test_running_total_and_numbering(spark):
    frame = spark.createDataFrame([(n, n % 5) for n in range(500)], "id INT, w INT").repartition(7)
    got = {r["id"]: r["total"] for r in order.running_total(frame, ["id"], {"total": "w"}).collect()}
    assert got == {n: sum(m % 5 for m in range(n + 1)) for n in range(500)}
    placed = order.numbered(frame, ["w", "id"], "n").orderBy("n").collect()
    assert [r["n"] for r in placed] == list(range(500))
    assert [(r["w"], r["id"]) for r in placed] == sorted((n % 5, n) for n in range(500))


def test_balance_takes_the_first_rows_in_hash_order(spark):
    import hashlib

    rows = [(n, 1 if n % 10 == 0 else 0) for n in range(3000)]
    frame = spark.createDataFrame(rows, "id INT, label INT").repartition(6)
    chosen = O.balance(frame, "label", "id").collect()
    assert sum(r["label"] for r in chosen) == 300 and len(chosen) == 600
    hashed = sorted((hashlib.md5(f"{n}|42".encode()).hexdigest(), n) for n, label in rows if label == 0)
    assert {r["id"] for r in chosen if r["label"] == 0} == {n for _, n in hashed[:300]}
    few = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "id INT, label INT")
    assert O.balance(few, "label", "id").count() == 3


def test_first_by_key_with_crowded_buckets(spark):
    rows = [(n, f"{n % 7:04x}{n:08x}") for n in range(700)]
    frame = spark.createDataFrame(rows, "id INT, key STRING").repartition(4)
    for wanted in (0, 1, 99, 100, 101, 650, 700, 900):
        got = order.first_by_key(frame, "key", "id", F.lit(wanted)).collect()
        assert {r["id"] for r in got} == {n for _, n in sorted((k, n) for n, k in rows)[:wanted]}


def test_hash_split_is_stable_and_complete(spark):
    frame = spark.range(5000).select(F.col("id"))
    train, test = O.hash_split(frame, ["id"])
    again, _ = O.hash_split(frame.repartition(9), ["id"])
    assert train.count() + test.count() == 5000
    assert train.exceptAll(again).count() == 0 and 3800 < train.count() < 4200


def test_outliers_and_missing_values(spark, rows):
    frame = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 2, 2, 100)], "v DOUBLE")
    assert (100.0,) not in rows(O.drop_outliers(frame, "v"))
    holes = spark.createDataFrame([(1.0, "a"), (None, "b"), (float("nan"), "c")], "v DOUBLE, k STRING")
    assert rows(O.drop_missing(holes)) == [(1.0, "a")]
    assert rows(O.drop_outliers(frame.where("v < 0"), "v")) == []


def test_top_group_breaks_ties(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "k STRING")
    assert tuple(O.top_group(frame, "k", F.count("*"), "k", "n").first()) == ("a", 2)


def test_hash_split_is_the_split_by_number(spark):
    frame = spark.range(2000)
    for share in (0.0, 0.25, 0.8, 1.0):
        inside, outside = O.hash_split(frame, ["id"], share)
        assert inside.where(X.unit_hash("id") >= share).isEmpty() and outside.where(X.unit_hash("id") < share).isEmpty()
        assert inside.count() + outside.count() == 2000
