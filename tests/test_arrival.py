"""Time-ordered arrivals, progress, keyed merges and operators with their own state."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import logs
from millrace.session import new_folder
from millrace.streaming import arrival, run, state


def moments(spark, *rows):
    """Rows of (minute, key, id)."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    frame = spark.createDataFrame(list(rows), "m INT, k STRING, id INT")
    return frame.select((start + F.make_dt_interval(mins=F.col("m"))).alias("t"), "k", "id")


def test_files_arrive_in_order_of_time(spark):
    frame = moments(spark, *[(n * 7 % 100, "a", n) for n in range(100)])
    path = arrival.land_in_order([frame], "t", files=5)
    seen = []

    def note(batch, batch_id):
        seen.append(batch.agg(F.min("t"), F.max("t"), F.count("*")).first())

    run.drain(arrival.arrivals(spark, path, frame), note)
    assert len(seen) == 5 and sum(r[2] for r in seen) == 100
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))
    with pytest.raises(ValueError):
        arrival.land_in_order([], "t")


def test_state_falls_and_the_last_row_closes_all_windows(spark):
    frame = moments(spark, *[(n * 10, "k", n) for n in range(60)])
    last = arrival.closing_rows(frame, "t", {"k": "last", "id": -1})
    assert [tuple(r)[1:] for r in last.collect()] == [("last", -1)]
    path = arrival.land_in_order([frame, last], "t", files=4)
    counts = logs.windowed_counts(arrival.arrivals(spark, path, frame), "5 minutes", keys=["k"], delay="3 minutes", time="t")
    out = new_folder(spark, "out")
    steps = run.progress_table(run.drain(counts, "parquet", path=out)).orderBy("batch_id").collect()
    assert spark.read.parquet(out).count() == 60
    assert sum(s["input_rows"] for s in steps) == 61
    held = [s["state_rows"] for s in steps]
    assert max(held) < 60 and held[-1] == 1 and any(b < a for a, b in zip(held, held[1:]))
    assert arrival.closing_rows(frame.limit(0), "t").count() == 0


def test_merge_reads_one_snapshot_and_the_deltas_since(spark):
    path, order = new_folder(spark, "merged"), ["t"]
    schema = moments(spark).schema
    write = run.merge_batches(path, ["k"], order, compact_every=3)
    newest = {}
    for batch in range(8):
        rows = [(100 - batch if k == 1 else batch, f"k{k}", 10 * batch + k) for k in range(batch % 3 + 1)]
        frame = moments(spark, *rows)
        write(frame, batch)
        write(frame, batch)  # delivered twice
        for m, k, i in rows:
            if k not in newest or m >= newest[k][0]:
                newest[k] = (m, i)
    table = run.merged_table(path, ["k"], schema, spark, order)
    assert {r["k"]: r["id"] for r in table.collect()} == {k: i for k, (_, i) in newest.items()}
    folders = {tuple(name.split("/")[-3:-1]) for name in table.inputFiles()}
    assert folders == {("snapshots", "000000005"), ("deltas", "000000006"), ("deltas", "000000007")}
    assert run.merged_table(new_folder(spark, "none"), ["k"], schema, spark).count() == 0


def test_sessions_merge_over_triggers(spark):
    frame = moments(spark, (0, "a", 1), (8, "a", 2), (40, "a", 3), (3, "b", 4), (12, "b", 5), (21, "b", 6))
    last = arrival.closing_rows(frame, "t", {"k": "last"})
    arriving = arrival.arrivals(spark, arrival.land_in_order([frame, last], "t", files=3), frame)
    found = run.result(logs.session_counts(arriving, "10 minutes", ["k"], "1 minute", "t"))
    minutes = lambda c: ((F.col(c).cast("long") - F.lit("2024-01-01 00:00:00").cast("timestamp").cast("long")) / 60).cast("int")
    got = sorted(tuple(r) for r in found.select("k", minutes("start"), minutes("end"), "n").collect())
    assert got == [("a", 0, 18, 2), ("a", 40, 50, 1), ("b", 3, 31, 3)]
    batch = logs.session_counts(frame, "10 minutes", ["k"], time="t")
    assert batch.count() == 3


def test_alerts_count_over_triggers_and_forget(spark):
    frame = moments(spark, (0, "a", 1), (5, "a", 2), (9, "a", 3), (30, "a", 4), (31, "a", 5), (32, "b", 6), (40, "a", 7), (41, "a", 8))
    last = arrival.closing_rows(frame, "t", {"k": "last", "id": 99})
    arriving = arrival.arrivals(spark, arrival.land_in_order([frame, last], "t", files=4), frame)
    alerts = state.repeated_errors(arriving, "k", "t", "id", every=2, quiet="10 minutes", delay="1 minute")
    path = new_folder(spark, "alerts")
    steps = run.progress_table(run.drain(alerts, "parquet", path=path))
    assert sorted((r["k"], r["id"], r["errors"]) for r in spark.read.parquet(path).collect()) == [("a", 2, 2), ("a", 5, 2), ("a", 8, 4)]
    assert steps.agg(F.max_by("state_rows", "batch_id")).first()[0] <= 3  # only the last key is left


def test_files_grow_in_number_not_in_rows(spark, monkeypatch):
    monkeypatch.setattr(arrival, "FILE_ROWS", 10, raising=False)
    frame = moments(spark, *[(n * 7 % 100, "a", n) for n in range(100)])
    path = arrival.land_in_order([frame], "t")
    seen = []
    run.drain(arrival.arrivals(spark, path, frame), lambda batch, number: seen.append(batch.count()))
    assert sum(seen) == 100 and len(seen) == 10 and max(seen) < 20
