"""Compare registered queries with their SQL: row count, column names, types and values.

Also a script: python tests/oracle.py [data folder] [name prefixes…]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

FAMILIES = {
    "INTEGER": "int", "BIGINT": "bigint", "SMALLINT": "smallint", "DOUBLE": "double", "FLOAT": "float",
    "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
    "HUGEINT": "hugeint",
}


def connect(sf_dir: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return repr(value)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr([plain(row[i]) for i in order]) for row in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, db, query, sql, sf_dir):
    """Empty text if the results agree, else what differs."""
    frame = query(spark, sf_dir)
    got = [tuple(row) for row in frame.collect()]
    relation = db.sql(sql)
    expected = relation.fetchall()
    want_types = {c: FAMILIES.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    have_types = dict(frame.dtypes)
    if set(want_types) != set(have_types):
        return f"columns {sorted(have_types)} against {sorted(want_types)}", len(got)
    if len(got) != len(expected):
        return f"{len(got)} rows against {len(expected)}", len(got)
    mine, my_lines = digest(frame.columns, got)
    theirs, their_lines = digest(relation.columns, expected)
    if mine != theirs:
        extra = [l for l in my_lines if l not in set(their_lines)][:2]
        missing = [l for l in their_lines if l not in set(my_lines)][:2]
        return f"values: only here {extra}, only there {missing}", len(got)
    if want_types != have_types:
        odd = {c: (have_types[c], want_types[c]) for c in want_types if want_types[c] != have_types[c]}
        return f"types {odd}", len(got)
    return "", len(got)


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as registry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for setting in filter(None, os.environ.get("EXTRA_CONF", "").split(";")):
        spark = spark.config(*setting.split("=", 1))
    spark = spark.getOrCreate()
    spark.sparkContext.setLogLevel("OFF" if os.environ.get("QUIET") else "ERROR")
    db = connect(sf_dir)
    queries, sql = registry.queries(), registry.oracle_sql()
    bad = []
    for name, query in queries.items():
        if not name.startswith(prefixes):
            continue
        started = time.time()
        try:
            if name in sql:
                problem, rows = compare(spark, db, query, sql[name], sf_dir)
            else:
                problem, rows = "", query(spark, sf_dir).count()
        except Exception as failure:  # noqa: BLE001 - reported below
            problem, rows = f"{type(failure).__name__}: {str(failure)[:600]}", -1
        state = problem or ("ok" if name in sql else "ok (rows only)")
        print(f"{name:36s} {time.time() - started:6.2f}s {rows:8d}  {state}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} differ: {bad}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
