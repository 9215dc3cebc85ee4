"""Column expressions. All are built from Spark functions and stay inside code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Score bands of the viewing report and of its variant with strict limits,
# categories of an acidity measure, and the limits of the absolute-error histogram.
SCORE_BANDS = [(0.9, 10), (0.5, 4), (0.25, 2)]
SCORE_BANDS_STRICT = [(0.9, 10), (0.5, 6), (0.25, 2)]
ACIDITY_BANDS = [(3.25, "HIGH"), (3.1, "MEDIUM")]
ERROR_EDGES = [50, 200, 500, 5000]

# Mean radius of the earth in km, and the factor for the length of real routes.
EARTH_RADIUS_KM = 6371.0
ROUTE_FACTOR = 1.1


def basename(path: str | Column) -> Column:
    """Part of a path after the last slash."""
    return F.substring_index(_column(path), "/", -1)


def score_bands(
    column: str | Column, bands: Sequence[tuple[float, object]], otherwise: object, strict: bool = False
) -> Column:
    """First band whose lower limit the value reaches (exceeds, if `strict`)."""
    value = _column(column)
    chosen = None
    for limit, result in bands:
        hit = value > limit if strict else value >= limit
        chosen = F.when(hit, F.lit(result)) if chosen is None else chosen.when(hit, F.lit(result))
    return F.lit(otherwise) if chosen is None else chosen.otherwise(F.lit(otherwise))


def level_band(level: str | Column) -> Column:
    """HIGH for errors and fatal messages, LOW for all others."""
    return F.when(_column(level).isin("ERROR", "FATAL"), "HIGH").otherwise("LOW")


def haversine(
    lat1: str | Column,
    lon1: str | Column,
    lat2: str | Column,
    lon2: str | Column,
    radius: float = EARTH_RADIUS_KM * ROUTE_FACTOR,
) -> Column:
    """Great-circle distance in the unit of `radius` between points given in degrees.

    Written so that the squared half chord occurs once: Spark repeats an expression wherever a
    column made from it is used.
    """
    lat1, lon1, lat2, lon2 = map(_column, (lat1, lon1, lat2, lon2))
    half_lat = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
    half_lon = F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    chord = half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def speed(distance: str | Column, seconds: str | Column) -> Column:
    """Distance per hour; null where no time passed."""
    return F.try_divide(_column(distance), _column(seconds) / F.lit(3600.0))


def signed_number(text: str | Column) -> Column:
    """Integer from digits with a leading sign, as in fixed-width measurements."""
    return F.regexp_replace(_column(text), "^\\+", "").try_cast("int")


def order_key(*columns: str | Column, seed: int = 42) -> Column:
    """Reproducible pseudo-random text per row: hex digits that depend on the values and the seed."""
    parts = [_column(c).cast("string") for c in columns]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))).cast("binary"))


def unit_hash(*columns: str | Column, seed: int = 42) -> Column:
    """Reproducible pseudo-random number in [0, 1)."""
    digits = F.substring(order_key(*columns, seed=seed), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def token(column: str | Column, position: int, pattern: str = "\\s") -> Column:
    """1-based token of a text; null where the text is shorter."""
    return F.try_element_at(F.split(_column(column), pattern), F.lit(position))


def us_date(column: str | Column) -> Column:
    """`MM/dd/yyyy` to a date, null if it is not one."""
    return F.try_to_date(_column(column), "MM/dd/yyyy")


def us_timestamp(column: str | Column) -> Column:
    """`MM/dd/yyyy hh:mm:ss a` to a timestamp, null if it is not one."""
    return F.try_to_timestamp(_column(column), F.lit("MM/dd/yyyy hh:mm:ss a"))


def _column(item: str | Column) -> Column:
    return F.col(item) if isinstance(item, str) else item
