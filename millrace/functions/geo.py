"""Great-circle distance and the grid that turns a radius test into an equi-join."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value.
EARTH_RADIUS_KM = 6371
# Widening of every bound, far above double rounding and far below a metre.
_SLACK = 1 + 1e-9


def great_circle_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Spherical law of cosines; the cosine is clamped so equal points give about 0."""
    a1, o1, a2, o2 = (F.radians(c.cast("double")) for c in (lat1, lng1, lat2, lng2))
    cosine = F.cos(a1) * F.cos(a2) * F.cos(o2 - o1) + F.sin(a1) * F.sin(a2)
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine))
    return F.lit(EARTH_RADIUS_KM) * F.acos(clamped)


def bounding_box(lat: float, lng: float, radius_km: float) -> tuple[float, float, float | None, float | None]:
    """``(lat_min, lat_max, lng_min, lng_max)`` holding the whole circle.

    The longitudes are None when the circle touches a pole or crosses the date line.
    """
    angle = min(radius_km / EARTH_RADIUS_KM * _SLACK, math.pi)
    reach = math.degrees(angle) + 1e-9
    low, high = lat - reach, lat + reach
    if low <= -90 or high >= 90:
        return max(low, -90.0), min(high, 90.0), None, None
    spread = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat))))) * _SLACK + 1e-9
    west, east = lng - spread, lng + spread
    if west < -180 or east > 180:
        return low, high, None, None
    return low, high, west, east


@dataclass(frozen=True)
class RadiusGrid:
    """Latitude bands cut into longitude cells, both at least one radius wide.

    Two points closer than the radius lie in the same or in touching cells, so a point
    needs to meet nine cells at most.  The number of cells in a band shrinks toward the
    poles (down to one), and cells wrap around the date line.
    """

    radius_km: float

    @property
    def _angle(self) -> float:
        return min(self.radius_km / EARTH_RADIUS_KM * _SLACK, math.pi)

    @property
    def _height(self) -> float:
        return max(math.degrees(self._angle) * _SLACK, 1e-6)

    def band(self, lat: Column) -> Column:
        return F.floor((lat.cast("double") + 90) / F.lit(self._height))

    def cells_in(self, band: Column) -> Column:
        """How many longitude cells a band has."""
        south = F.lit(-90.0) + (band - 1) * F.lit(self._height)
        north = F.lit(-90.0) + (band + 2) * F.lit(self._height)
        furthest = F.least(F.lit(90.0), F.greatest(F.abs(south), F.abs(north)))
        ratio = F.lit(math.sin(self._angle / 2)) / F.greatest(F.cos(F.radians(furthest)), F.lit(1e-12))
        width = F.degrees(2 * F.asin(F.least(F.lit(1.0), ratio))) * F.lit(_SLACK)
        count = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(360.0) / width))
        return F.when(ratio < 1, count).otherwise(F.lit(1).cast("bigint"))

    def _raw_cell(self, lng: Column, count: Column) -> Column:
        return F.floor((lng.cast("double") + 180) / (F.lit(360.0) / count))

    def cell(self, lng: Column, band: Column) -> Column:
        count = self.cells_in(band)
        return F.pmod(self._raw_cell(lng, count), count)

    def home(self, lat: Column, lng: Column) -> Column:
        """The one ``struct(band, cell)`` a point lies in."""
        band = self.band(lat)
        return F.struct(band.alias("band"), self.cell(lng, band).alias("cell"))

    def reach(self, lat: Column, lng: Column) -> Column:
        """Array of every ``struct(band, cell)`` that can hold a point within the radius."""
        home = self.band(lat)

        def row(step: Column) -> Column:
            band = home + step
            count = self.cells_in(band)
            start = self._raw_cell(lng, count)
            around = F.array_distinct(F.array(*[F.pmod(start + F.lit(d), count) for d in (-1, 0, 1)]))
            return F.transform(around, lambda c: F.struct(band.alias("band"), c.alias("cell")))

        steps = F.array(*[F.lit(d).cast("bigint") for d in (-1, 0, 1)])
        return F.flatten(F.transform(steps, row))
