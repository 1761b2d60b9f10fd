"""Boolean expressions that are never NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from worksledger import constants as C
from worksledger.functions.text import strip_spaces


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _or_false(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def in_bbox(
    lat: Column | str,
    lon: Column | str,
    lat_range: tuple[float, float] = C.LATITUDE_RANGE,
    lon_range: tuple[float, float] = C.LONGITUDE_RANGE,
) -> Column:
    """Inside the box, edges included; a missing coordinate is outside."""
    return _or_false(_col(lat).between(*lat_range) & _col(lon).between(*lon_range))


def is_positive(col: Column | str) -> Column:
    return _or_false(_col(col) > 0)


def is_filled(col: Column | str) -> Column:
    """Something other than spaces."""
    return _or_false(strip_spaces(col) != "")
