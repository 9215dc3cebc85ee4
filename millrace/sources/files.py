"""File sources and sinks: text, CSV, Parquet, fixed-width lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_text(spark: SparkSession, path: str | Sequence[str], with_file: bool = False) -> DataFrame:
    """One row per line in `value`; globs allowed. `with_file` adds the base name in `file`."""
    lines = spark.read.text(path)
    if with_file:
        lines = lines.select("value", F.col("_metadata.file_name").alias("file"))
    return lines


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, header: bool = True, sep: str = ","
) -> DataFrame:
    """CSV with a declared schema: one pass, no inference job."""
    return spark.read.schema(schema).option("header", header).option("sep", sep).csv(path)


def read_csv_inferred(
    spark: SparkSession, path: str, sep: str = ",", sampling: float = 1.0, header: bool = True
) -> DataFrame:
    """CSV whose types Spark infers from a `sampling` share of the rows (an extra scan)."""
    return (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("inferSchema", True)
        .option("samplingRatio", sampling)
        .csv(path)
    )


def read_csv_strings(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, header: bool = True
) -> DataFrame:
    """CSV with every column a string; name the columns to spare the header scan."""
    reader = spark.read.option("header", header)
    if columns:
        reader = reader.schema(", ".join(f"`{name}` STRING" for name in columns))
    return reader.csv(path)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; text that does not parse becomes null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def from_rows(
    spark: SparkSession, rows: Sequence[Sequence[Any]], schema: StructType | str
) -> DataFrame:
    """Small in-memory table (lookups, fixtures) with a typed schema."""
    return spark.createDataFrame(rows, schema)


def read_fixed_width(
    df: DataFrame, spec: Mapping[str, tuple[int, int]], column: str = "value"
) -> DataFrame:
    """Cut fields out of a line. `spec` gives 0-based start and exclusive end per field."""
    return df.select(
        *[
            F.substring(F.col(column), start + 1, end - start).alias(name)
            for name, (start, end) in spec.items()
        ]
    )


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Overwrite a typed snapshot and return it as read back."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, one_file: bool = False, header: bool = False) -> None:
    """Overwrite as CSV.

    `one_file` sends all rows through one task, so ask for it only on reports whose size
    does not grow with the input. The stage before is kept parallel by a shuffle.
    """
    out = df.repartition(1) if one_file else df
    out.write.mode("overwrite").option("header", header).csv(path)


def key_value_lines(df: DataFrame, key: str | Column, value: str | Column) -> DataFrame:
    """`key<TAB>value` in one string column."""
    return df.select(
        F.concat_ws("\t", _column(key).cast("string"), _column(value).cast("string")).alias("value")
    )


def write_kv_text(df: DataFrame, path: str, key: str | Column, value: str | Column) -> None:
    """Overwrite as text lines `key<TAB>value`."""
    key_value_lines(df, key, value).write.mode("overwrite").text(path)


def _column(item: str | Column) -> Column:
    return F.col(item) if isinstance(item, str) else item
