"""Station and location codes.

A station code is ``base + location number``. Three spellings of the location
are in use: the last ``width`` digits, the number itself, and the number padded
with zeros. Joins between them pad both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bloomline.config import LOCATION_WIDTH, STATION_BASE


def location_code(station_code: Column, width: int = LOCATION_WIDTH) -> Column:
    """Padded location code: the last ``width`` digits of the station code."""
    return F.right(station_code.cast("string"), F.lit(width))


def location_number(station_code: Column, base: int = STATION_BASE) -> Column:
    """Unpadded location code."""
    return (station_code.cast("long") - F.lit(base).cast("long")).cast("string")


def pad_location(code: Column, width: int = LOCATION_WIDTH) -> Column:
    return F.lpad(code.cast("string"), width, "0")
