from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace.operators import topics
from millrace.sources.topics import read_position


def log(spark, count=1000):
    """Records of which most are in one partition."""
    rows = [(n, 0 if n % 3 else n % 2 + 1) for n in range(count)]
    frame = spark.createDataFrame(rows, "seq BIGINT, partition INT").repartition(6)
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("seq"))
    return frame.withColumns({"timestamp": moment, "key": F.col("partition").cast("string"), "value": F.lit("v")})


def test_offsets_are_consecutive_whatever_the_bucket(spark):
    for bucket in (1, 7, 64, 100_000):
        got = topics.assign_offsets(log(spark), "seq", bucket).collect()
        for partition in (0, 1, 2):
            mine = sorted((r["seq"], r["offset"]) for r in got if r["partition"] == partition)
            assert [o for _, o in mine] == list(range(len(mine)))


def test_read_positions(spark):
    stored = topics.assign_offsets(log(spark), "seq")
    assert read_position(stored, "earliest").count() == 1000
    assert read_position(stored, "latest").count() == 0
    assert read_position(stored, "earliest", limit=2).groupBy("partition").count().where("count = 2").count() == 3
    since = read_position(stored, datetime(2024, 1, 1, 0, 10))
    assert since.count() == 400 and since.agg(F.min("seq")).first()[0] == 600
    assert read_position(stored, timedelta(seconds=99)).count() == 100
    committed = spark.createDataFrame([(0, 600), (1, 5)], "partition INT, current_offset BIGINT")
    shifted = {r[0]: r[1] for r in read_position(stored, -10, committed=committed).groupBy("partition").agg(F.min("offset")).collect()}
    assert shifted == {0: 590, 1: 0, 2: 0}


def test_group_lag(spark, rows):
    stored = topics.assign_offsets(log(spark, 12), "seq")
    committed = spark.createDataFrame([(0, 8), (1, 1)], "partition INT, current_offset BIGINT")
    assert rows(topics.group_lag(stored, committed)) == [(0, 8, 8, 0), (1, 1, 2, 1), (2, 0, 2, 2)]


def test_same_key_same_partition_and_order(spark, tmp_path):
    keyed = topics.assign_partition(log(spark).drop("partition"), 4)
    spread = keyed.groupBy("key").agg(F.count_distinct("partition").alias("n"))
    assert spread.where("n > 1").count() == 0
    stored = topics.assign_offsets(keyed, "seq")
    assert topics.order_violations(stored).agg(F.sum("violations")).first()[0] == 0
    back = topics.write_topic(stored, str(tmp_path / "topic"), tasks=5)
    parts = back.groupBy(F.input_file_name().alias("f"), "partition").agg(
        F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count("*").alias("n")
    )
    # Each file holds an unbroken run of a partition's offsets.
    assert parts.where("hi - lo + 1 != n").count() == 0
    early = F.lit("2000-01-01").cast("timestamp_ntz")
    wrong = stored.withColumn("timestamp", F.when(F.col("seq") == 500, early).otherwise(F.col("timestamp")))
    assert topics.order_violations(wrong).agg(F.sum("violations")).first()[0] == 1


def test_listing_shows_missing_keys(spark):
    frame = spark.createDataFrame(
        [(0, 0, None, "Plot"), (0, 1, "genre", "[rts]")], "partition INT, offset BIGINT, key STRING, value STRING"
    )
    assert [r["line"] for r in topics.key_value_listing(frame).orderBy("offset").collect()] == ["null:Plot", "genre:[rts]"]
