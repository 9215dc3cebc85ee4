"""Structured record payloads with nullable fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType


def decode_payload(
    df: DataFrame,
    schema: StructType,
    column: str = "value",
    out: str = "payload",
    strict: bool = True,
) -> DataFrame:
    """Text payload to a struct of `schema`.

    A reader schema narrower than the writer's simply leaves fields out. With `strict`, a
    payload carrying a field that `schema` does not know, or that is malformed, fails the job.
    """
    parsed = F.from_json(F.col(column), schema, {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    if strict:
        known = F.array(*[F.lit(name) for name in schema.fieldNames()])
        extra = F.array_except(F.json_object_keys(F.col(column)), known)
        parsed = F.when(
            F.size(extra) > 0,
            F.raise_error(F.concat(F.lit("unknown field: "), F.array_join(extra, ","))).cast(schema),
        ).otherwise(parsed)
    return df.withColumn(out, parsed)


def read_as(df: DataFrame, schema: StructType, column: str = "value", out: str = "payload") -> DataFrame:
    """Narrower reader schema: keep only the fields of `schema`, null where one is missing."""
    return decode_payload(df, schema, column, out, strict=False)


def encode_payload(df: DataFrame, columns: list[str], out: str = "value") -> DataFrame:
    """Columns to one text payload, null fields included."""
    struct: Column = F.struct(*columns)
    return df.withColumn(out, F.to_json(struct, {"ignoreNullFields": "false"}))


def avro_available(df: DataFrame) -> bool:
    """Whether the session carries the Avro module that `from_avro` and `to_avro` need."""
    try:
        df.sparkSession.read.format("avro").schema("a INT").load([])
    except Exception:
        return False
    return True


def decode_avro(df: DataFrame, avro_schema: str, column: str = "value", out: str = "payload") -> DataFrame:
    """Binary Avro payload to a struct, where the Avro module is deployed."""
    from pyspark.sql.avro.functions import from_avro

    return df.withColumn(out, from_avro(F.col(column), avro_schema, {"mode": "FAILFAST"}))


def encode_avro(df: DataFrame, columns: list[str], avro_schema: str, out: str = "value") -> DataFrame:
    """Columns to a binary Avro payload, where the Avro module is deployed."""
    from pyspark.sql.avro.functions import to_avro

    return df.withColumn(out, to_avro(F.struct(*columns), avro_schema))
