import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators import logs
from millrace.session import new_folder
from millrace.streaming import joins, run, words


def land(frame, path, number):
    frame.write.parquet(f"{path}/n={number}")


def moments(spark, *minutes):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    frame = spark.createDataFrame([(m,) for m in minutes], "m INT")
    return frame.select((start + F.make_dt_interval(mins=F.col("m"))).alias("event_time"))


def open_stream(spark, path, schema):
    return run.stream_files(spark, f"{path}/*", schema=schema)


def test_restart_reads_only_new_files(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    land(spark.range(5), source, 0)
    arriving = open_stream(spark, source, "id BIGINT")
    assert run.result(arriving, checkpoint=checkpoint, path=out).count() == 5
    assert run.result(arriving, checkpoint=checkpoint, path=out).count() == 5
    land(spark.range(5, 8), source, 1)
    assert sorted(r[0] for r in run.result(arriving, checkpoint=checkpoint, path=out).collect()) == list(range(8))


@pytest.mark.parametrize("delivery, expected", [("exactly_once", 4), ("at_least_once", 8), ("at_most_once", 4)])
def test_delivery_of_a_repeated_batch(spark, tmp_path, delivery, expected):
    source, out = str(tmp_path / "in"), new_folder(spark, "out")
    land(spark.range(4), source, 0)
    write = run.DELIVERY[delivery](out)

    def twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)

    run.drain(open_stream(spark, source, "id BIGINT"), twice)
    assert spark.read.parquet(out).count() == expected


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    land(moments(spark, 1, 2, 30), source, 0)
    schema = moments(spark).schema
    build = lambda: logs.windowed_counts(open_stream(spark, source, schema), "5 minutes", delay="3 minutes")
    out = new_folder(spark, "out")
    run.drain(build(), "parquet", checkpoint=checkpoint, path=out)
    land(moments(spark, 3, 31), source, 1)
    query = run.drain(build(), "parquet", checkpoint=checkpoint, path=out)
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert dropped > 0
    assert [(r["start"].minute, r["n"]) for r in spark.read.parquet(out).collect()] == [(0, 2)]


def test_modes_and_their_rules(spark, tmp_path):
    source = str(tmp_path / "in")
    frame = spark.createDataFrame([("a",), ("b",), ("a",)], "k STRING")
    land(frame, source, 0)
    counts = open_stream(spark, source, "k STRING").groupBy("k").agg(F.count("*").alias("n"))
    assert {tuple(r) for r in run.result(counts, "complete").collect()} == {("a", 2), ("b", 1)}
    assert {tuple(r) for r in run.result(counts, "update", ["k"]).collect()} == {("a", 2), ("b", 1)}
    with pytest.raises(AnalysisException):  # append needs a watermark
        run.drain(counts, "parquet", path=new_folder(spark, "out"))
    with pytest.raises(AnalysisException):  # sorting needs complete mode
        run.drain(counts.orderBy("n"), run.replace_batch(new_folder(spark, "out")), mode="update")
    with pytest.raises(AnalysisException):  # files only take appended rows
        run.drain(counts, "parquet", mode="complete", path=new_folder(spark, "out"))


def test_triggers(spark, tmp_path):
    source = str(tmp_path / "in")
    for number in range(3):
        land(spark.range(2), source, number)
    one_by_one = run.stream_files(spark, f"{source}/*", schema="id BIGINT", max_files=1)
    out = new_folder(spark, "out")
    query = run.drain(one_by_one, run.replace_batch(out))
    assert query.lastProgress["batchId"] >= 2
    running = run.run_stream(
        open_stream(spark, source, "id BIGINT"), "parquet", path=new_folder(spark, "out"),
        trigger={"processingTime": "1 second"},
    )
    running.processAllAvailable()
    running.stop()
    assert not running.isActive


def test_console_and_memory_sinks(spark, tmp_path, capfd):
    source = str(tmp_path / "in")
    land(spark.createDataFrame([("hello stream",)], "value STRING"), source, 0)
    counts = words.running_word_count(open_stream(spark, source, "value STRING"))
    run.drain(counts, "console", mode="complete", truncate=False, numRows=100)
    run.drain(counts, "memory", mode="complete", name="seen_words")
    assert {r["word"] for r in spark.table("seen_words").collect()} == {"hello", "stream"}
    spark.table("seen_words").show(1, truncate=False)


def sides(spark, base):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")

    def side(rows, name):
        frame = spark.createDataFrame(rows, "k INT, m INT")
        return frame.select("k", (start + F.make_dt_interval(mins=F.col("m"))).alias(f"{name}_time"), F.col("m").alias(f"{name}_m"))

    return side(base[0], "l"), side(base[1], "r")


def test_interval_join_keeps_lone_rows_of_either_side(spark, rows):
    l = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP'2024-01-01 00:10:00'), (2, TIMESTAMP'2024-01-01 00:10:00'), (NULL, TIMESTAMP'2024-01-01 00:10:00') t(k, l_time)")
    r = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP'2024-01-01 00:20:00'), (3, TIMESTAMP'2024-01-01 09:00:00'), (NULL, TIMESTAMP'2024-01-01 00:20:00') t(k, r_time)")

    def keys(how):
        joined = joins.interval_join(l, r, ["k"], "l_time", "r_time", "1 hour", how=how)
        assert joined.columns == ["k", "l_time", "r_time"]
        return sorted((str(x["k"]), x["l_time"] is not None, x["r_time"] is not None) for x in joined.collect())

    lone_right = [("3", False, True), ("None", False, True)]
    lone_left = [("2", True, False), ("None", True, False)]
    assert keys("right_outer") == sorted([("1", True, True), *lone_right])
    assert keys("full_outer") == sorted([("1", True, True), *lone_left, *lone_right])
    with pytest.raises(ValueError):
        keys("cross")


def test_interval_join_against_brute_force(spark):
    import random

    draw = random.Random(3)
    # One key has a third of all rows.
    key = lambda n: 0 if n % 3 == 0 else draw.randrange(5)
    left = [(key(n), draw.randrange(1000)) for n in range(300)]
    right = [(key(n), draw.randrange(1000)) for n in range(300)]
    pairs = sorted((k, a, b) for k, a in left for j, b in right if j == k and a <= b <= a + 60)
    l, r = sides(spark, (left, right))
    got = joins.interval_join(l, r, ["k"], "l_time", "r_time", "1 hour")
    assert sorted((x["k"], x["l_m"], x["r_m"]) for x in got.collect()) == pairs
    outer = joins.interval_join(l, r, ["k"], "l_time", "r_time", "1 hour", how="left_outer")
    lonely = [(k, a) for k, a in left if not any(j == k and a <= b <= a + 60 for j, b in right)]
    assert sorted((x["k"], x["l_m"]) for x in outer.where("r_m is null").collect()) == sorted(lonely)
    assert outer.count() == len(pairs) + len(lonely)


def test_stream_static_right_join_side(spark, tmp_path):
    source = str(tmp_path / "in")
    land(spark.createDataFrame([(1,), (2,)], "k INT"), source, 0)
    names = spark.createDataFrame([(1, "one")], "k INT, name STRING")
    stream = open_stream(spark, source, "k INT")
    kept = run.result(joins.enrich(names, stream, "k", "right_outer"))
    assert {tuple(r) for r in kept.collect()} == {(1, "one"), (2, None)}
    with pytest.raises(AnalysisException):
        run.result(joins.enrich(stream, names, "k", "right_outer"))


def test_interval_lengths():
    assert joins.seconds("90 seconds") == 90 and joins.seconds("1 hour") == 3600 and joins.seconds("2 days") == 172800


def test_text_and_csv_streams(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "a.txt").write_text(
        "ERROR web 2022-12-01 10:07:00.5 This is message 1\nINFO web 2022-12-01 10:08:00 This is message 2\n"
    )
    lines = run.stream_files(spark, str(tmp_path / "logs"), "text")
    parsed = run.result(logs.parse_log(lines))
    assert sorted((r["level"], r["event_time"].minute) for r in parsed.collect()) == [("ERROR", 7), ("INFO", 8)]
    one = run.stream_files(spark, str(tmp_path / "logs" / "a.txt"), "text")
    assert run.result(one).count() == 2
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "m.csv").write_text("ERROR,0,2022-12-01,10:07:00,hello\nWARN,4,2022-12-01,10:09:00,\n")
    schema = "loglevel STRING, source INT, day STRING, time STRING, message STRING"
    messages = run.stream_files(spark, str(tmp_path / "csv"), "csv", schema, header=False)
    timed = messages.select(
        F.col("loglevel").alias("level"),
        F.concat_ws(" ", "day", "time").cast("timestamp").alias("event_time"),
    )
    bands = run.result(logs.band_counts(timed, "5 minutes"), "complete")
    assert [(r["low"], r["high"]) for r in bands.collect()] == [(1, 1)]
