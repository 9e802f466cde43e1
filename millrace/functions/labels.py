"""Display text computed next to the data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _hundredths(value: Column) -> Column:
    return F.round(value.cast("decimal(20,2)") * 100).cast("bigint")


def capacity_label(mw: Column) -> Column:
    """``'1.5 GW'`` from 1000 MW up, else ``'n MW'``, both rounded half up.

    Integer arithmetic on hundredths keeps ties exact.
    """
    cents = _hundredths(mw)
    tenths = F.floor((cents + 5000) / 10000)
    gigawatts = F.concat(
        F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit(" GW")
    )
    size = F.floor((F.abs(cents) + 50) / 100)
    megawatts = F.concat(F.when(cents < 0, -size).otherwise(size).cast("string"), F.lit(" MW"))
    return F.when(cents >= 100000, gigawatts).otherwise(megawatts)


def number_label(value: Column) -> Column:
    """Thousands separators, at most three fraction digits, no trailing zeros."""
    return F.call_function("format_number", value, F.lit("#,##0.###"))


def display_default(value: Column, default: str = "Unknown", number: bool = False) -> Column:
    """Default for null and empty text, or with ``number`` for null and zero."""
    missing = F.lit(0) if number else F.lit("")
    return F.coalesce(F.nullif(value, missing).cast("string"), F.lit(default))


def fixed_label(value: Column, digits: int) -> Column:
    """Exactly ``digits`` decimals, rounded half away from zero."""
    return F.round(value.cast("decimal(24,10)"), digits).cast(f"decimal(24,{digits})").cast("string")


def coordinate_label(latitude: Column, longitude: Column, digits: int = 4) -> Column:
    return F.concat_ws(", ", fixed_label(latitude, digits), fixed_label(longitude, digits))


def map_query(latitude: Column, longitude: Column) -> Column:
    """The ``?q=lat,lng`` part of a map link."""
    return F.concat(F.lit("?q="), latitude.cast("string"), F.lit(","), longitude.cast("string"))
