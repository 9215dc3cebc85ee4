from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from millrace.operators.reports import type_calls
from millrace.sources import files, payload, topics

FIRST = "Dit is een tekst.\nDit is géén grap.\nPhantom Dust forever.\n"
SECOND = "hallo\ndit ben ik\nuit de toekomst\nik hoop dat je mij kan horen\n"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "textfile.txt").write_text(FIRST)
    (tmp_path / "future.txt").write_text(SECOND)
    return str(tmp_path)


def test_text_with_glob_and_file_name(spark, folder, rows):
    lines = files.read_text(spark, f"{folder}/*.txt", with_file=True)
    assert rows(lines.groupBy("file").count()) == [("future.txt", 4), ("textfile.txt", 3)]
    assert files.read_text(spark, f"{folder}/future.txt").columns == ["value"]


def test_csv_with_declared_inferred_and_string_schema(spark, tmp_path, rows):
    path = tmp_path / "a.csv"
    path.write_text("id;price\n1;2.5\n2;n/a\n")
    typed = files.read_csv(spark, str(path), "id INT, price STRING", sep=";")
    assert rows(typed) == [(1, "2.5"), (2, "n/a")]
    good = tmp_path / "b.csv"
    good.write_text("id;price\n1;2.5\n2;3\n")
    assert dict(files.read_csv_inferred(spark, str(good), sep=";").dtypes) == {"id": "int", "price": "double"}
    plain = tmp_path / "c.csv"
    plain.write_text("id,price\n1,2.5\n2,n/a\n")
    text = files.read_csv_strings(spark, str(plain))
    assert set(dict(text.dtypes).values()) == {"string"}
    cast = files.cast_columns(text, {"id": "int", "price": "double"})
    assert {tuple(r) for r in cast.collect()} == {(1, 2.5), (2, None)}


def test_parquet_round_trip_keeps_types(spark, tmp_path, rows):
    calls = files.from_rows(
        spark,
        [("01/11/2018", "01/10/2018", "01/11/2018 01:51:44 PM"), ("13/45/2018", None, "noon")],
        "CallDate STRING, WatchDate STRING, AvailableDtTm STRING",
    )
    stored = files.write_parquet(type_calls(calls), str(tmp_path / "snapshot"))
    assert dict(stored.dtypes) == {"CallDate": "date", "WatchDate": "date", "AvailableDtTm": "timestamp"}
    first = stored.where("CallDate is not null").first()
    assert first["CallDate"] == date(2018, 1, 11)
    assert first["AvailableDtTm"] == datetime(2018, 1, 11, 13, 51, 44)
    assert stored.where("CallDate is null and AvailableDtTm is null").count() == 1


def test_one_file_csv_and_key_value_text(spark, tmp_path):
    report = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k STRING, n INT").repartition(3)
    files.write_csv(report, str(tmp_path / "one"), one_file=True)
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1
    files.write_kv_text(report, str(tmp_path / "kv"), "k", "n")
    assert {r["value"] for r in files.read_text(spark, str(tmp_path / "kv")).collect()} == {"a\t1", "b\t2", "c\t3"}


def test_fixed_width(spark):
    line = "x" * 15 + "1950" + "x" * 68 + "-0011" + "1"
    cut = files.read_fixed_width(
        spark.createDataFrame([(line,)], "value STRING"), {"year": (15, 19), "t": (87, 92), "q": (92, 93)}
    )
    assert tuple(cut.first()) == ("1950", "-0011", "1")


def test_topic_options():
    options = topics.source_options("host:1", ["a", "b"], {"a": {0: 7}}, 10)
    assert options["subscribe"] == "a,b"
    assert options["startingOffsets"] == '{"a": {"0": 7}}'
    assert options["maxOffsetsPerTrigger"] == "10"
    assert "startingTimestamp" in topics.source_options("h", "t", datetime(2024, 1, 1))
    assert topics.source_options("h", "t")["startingOffsets"] == "latest"
    assert "topic" not in topics.sink_options("h") and topics.sink_options("h", "t")["topic"] == "t"


def test_records_need_a_value(spark):
    frame = spark.createDataFrame([("k", "v"), (None, "w")], "k STRING, v STRING")
    encoded = topics.encode_records(frame, "v", "k", F.lit("out"))
    assert dict(encoded.dtypes) == {"key": "binary", "value": "binary", "topic": "string"}
    assert {(r["key"], r["value"]) for r in topics.decode_records(encoded).collect()} == {("k", "v"), (None, "w")}
    missing = spark.createDataFrame([("k", None)], "k STRING, v STRING")
    with pytest.raises(Exception, match="a record needs a value"):
        topics.encode_records(missing, "v").collect()


USER = StructType(
    [
        StructField("name", StringType(), True),
        StructField("favorite_number", IntegerType(), True),
        StructField("favorite_color", StringType(), True),
    ]
)


def test_payload_round_trip_and_unknown_field(spark):
    users = spark.createDataFrame([("Alice", 7, "red"), ("Bob", None, None)], USER)
    sent = payload.encode_payload(users, USER.names)
    back = payload.decode_payload(sent, USER).select("payload.*")
    assert {tuple(r) for r in back.collect()} == {("Alice", 7, "red"), ("Bob", None, None)}
    narrow = StructType(USER.fields[:1])
    assert payload.read_as(sent, narrow).where("payload.name = 'Alice'").count() == 1
    with pytest.raises(Exception, match="unknown field: favorite_number,favorite_color"):
        payload.decode_payload(sent, narrow).select("payload").collect()
