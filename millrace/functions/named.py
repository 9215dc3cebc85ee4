"""Functions callable by name from SQL and `call_function`.

They are declared as SQL functions, so Catalyst replaces each call by its expression: no
Python worker, and predicates over them still reach the scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession, functions as F

from millrace.functions.scalars import EARTH_RADIUS_KM, ROUTE_FACTOR

DECLARATIONS = {
    "file_basename": "(path STRING) RETURNS STRING RETURN substring_index(path, '/', -1)",
    "view_score": (
        "(share DOUBLE) RETURNS INT RETURN CASE WHEN share >= 0.9D THEN 10"
        " WHEN share >= 0.5D THEN 4 WHEN share >= 0.25D THEN 2 ELSE 0 END"
    ),
    "view_score_strict": (
        "(share DOUBLE) RETURNS INT RETURN CASE WHEN share > 0.9D THEN 10"
        " WHEN share > 0.5D THEN 6 WHEN share > 0.25D THEN 2 ELSE 0 END"
    ),
    "acidity_category": (
        "(ph DOUBLE) RETURNS STRING RETURN CASE WHEN ph >= 3.25D THEN 'HIGH'"
        " WHEN ph >= 3.1D THEN 'MEDIUM' ELSE 'LOW' END"
    ),
    "route_speed": (
        "(distance DOUBLE, seconds DOUBLE) RETURNS DOUBLE"
        " RETURN try_divide(distance, seconds / 3600D)"
    ),
    "route_distance": (
        "(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE RETURN"
        f" {2 * EARTH_RADIUS_KM * ROUTE_FACTOR}D * asin(sqrt(least(1D,"
        " pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2))"
        " * pow(sin(radians(lon2 - lon1) / 2), 2))))"
    ),
}


def register_all(spark: SparkSession) -> None:
    """Declare every named function for the life of the session."""
    for name, body in DECLARATIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")


def register_vectorised(spark: SparkSession, name: str, function: Callable, returns: str) -> None:
    """Name a user's own function over pandas Series, for what no expression can say."""
    spark.udf.register(name, F.pandas_udf(function, returns))
