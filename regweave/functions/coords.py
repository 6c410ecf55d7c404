"""Coordinates from text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
_STRAY_UNDERSCORE = r"(?:^|[^0-9])_|_(?:[^0-9]|$)"

# Column bounds, and the box a mappable point must lie in.
COORDINATE_BOUNDS = {"LATITUDE83": (-90.0, 90.0), "LONGITUDE83": (-180.0, 180.0)}
MAPPABLE_LATITUDE = (17, 72)
MAPPABLE_LONGITUDE = (-180, -64)


def decimal_text(c: Column) -> Column:
    """Text as a double; digits may be grouped by single underscores.

    The pattern keeps out what a JVM parse would let through (``1d``, ``0x1``).
    """
    plain = F.when(c.rlike(_NUMBER), c)
    grouped = F.when(
        c.contains("_") & ~c.rlike(_STRAY_UNDERSCORE), F.replace(c, F.lit("_"), F.lit(""))
    )
    return F.coalesce(plain, F.when(grouped.rlike(_NUMBER), grouped)).try_cast("double")


def in_bounds(value: Column, low: float = -180.0, high: float = 180.0) -> Column:
    """A coordinate inside inclusive bounds; zero means missing."""
    return F.when(value.between(low, high) & (value != 0), value)


def is_unmappable(latitude: Column, longitude: Column) -> Column:
    """A latitude without a usable point: no longitude, or outside the box."""
    return latitude.isNotNull() & (
        longitude.isNull()
        | ~latitude.between(*MAPPABLE_LATITUDE)
        | ~longitude.between(*MAPPABLE_LONGITUDE)
    )
