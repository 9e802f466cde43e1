"""Plants near a point, and plants near many points."""

from __future__ import annotations

from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.functions.geo import RadiusGrid, bounding_box, great_circle_km
from millrace.operators.nearest import nearest_k
from millrace.operators.paging import clamp_limit

DEFAULT_RADIUS_KM = 100.0
# The columns of a nearby plant.
NEARBY_COLUMNS = (
    "id",
    "gppd_idnr",
    "name",
    "country_code",
    "country",
    "capacity_mw",
    "latitude",
    "longitude",
    "primary_fuel",
)


def _radius(radius_km: float | None) -> float:
    """Absent, zero and NaN mean the default."""
    if not radius_km or radius_km != radius_km:
        return DEFAULT_RADIUS_KM
    return float(radius_km)


def _micro(degrees: float, rounding: str) -> Column:
    """Literal with the coordinates' own six decimals, so the stored column needs no cast."""
    return F.lit(Decimal(repr(degrees)).quantize(Decimal("0.000001"), rounding=rounding))


def nearby(
    plants: DataFrame,
    lat: float,
    lng: float,
    radius_km: float | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Nearest plants strictly inside the radius, nearest first: 20, or ``limit`` up to 100.

    The bounds are those of a request; `within_radius` gives all plants.  The circle's bounding box is a plain range on the stored columns, which reaches the
    parquet scan; the distance is computed only for what is left.
    """
    k = clamp_limit(limit, 20, 100)
    return within_radius(plants, lat, lng, radius_km).orderBy("distance_km", "id").limit(k)


def within_radius(plants: DataFrame, lat: float, lng: float, radius_km: float | None = None) -> DataFrame:
    """All plants strictly inside the radius, in no order."""
    if lat != lat or lng != lng:
        raise ValueError("coordinates must be numbers")
    radius = _radius(radius_km)
    south, north, west, east = bounding_box(lat, lng, radius)
    box = col("latitude").between(_micro(south, ROUND_FLOOR), _micro(north, ROUND_CEILING))
    if west is not None:
        box = box & col("longitude").between(_micro(west, ROUND_FLOOR), _micro(east, ROUND_CEILING))
    distance = great_circle_km(F.lit(lat), F.lit(lng), col("latitude"), col("longitude"))
    return (
        plants.where(box)
        .select(*[col(c) for c in NEARBY_COLUMNS], distance.alias("distance_km"))
        .where(F.col("distance_km") < radius)
    )


def nearby_join(
    centres: DataFrame,
    plants: DataFrame,
    radius_km: float | None = None,
    centre_id: str = "centre_id",
    centre_lat: str = "centre_lat",
    centre_lng: str = "centre_lng",
) -> DataFrame:
    """Every (centre, plant) pair strictly inside the radius, for any number of centres.

    An equi-join on grid cells: a plant sits in one cell, a centre visits the cells around
    its own, so a pair meets once and only near pairs are compared.  Join sides are left
    to Spark (a small centres table is broadcast by its measured size); a crowded cell is
    split by the adaptive skew join.
    """
    radius = _radius(radius_km)
    grid = RadiusGrid(radius)
    reach = centres.withColumn("_cell", F.explode(grid.reach(col(centre_lat), col(centre_lng))))
    reach = reach.select(
        "*", F.col("_cell.band").alias("_band"), F.col("_cell.cell").alias("_slot")
    ).drop("_cell")
    homes = plants.withColumn("_cell", grid.home(col("latitude"), col("longitude")))
    homes = homes.select(
        "*", F.col("_cell.band").alias("_band"), F.col("_cell.cell").alias("_slot")
    ).drop("_cell")
    pairs = homes.join(reach, ["_band", "_slot"]).drop("_band", "_slot")
    distance = great_circle_km(col(centre_lat), col(centre_lng), col("latitude"), col("longitude"))
    return pairs.withColumn("distance_km", distance).where(F.col("distance_km") < radius)


def nearest_join(
    centres: DataFrame,
    plants: DataFrame,
    radius_km: float | None = None,
    limit: int | None = None,
    centre_id: str = "centre_id",
) -> DataFrame:
    """The nearest plants of every centre inside the radius, ranked; all of them without ``limit``.

    With a limit only pairs near the k-th neighbour are formed (`nearest.nearest_k`, which
    also takes no radius at all); without one every pair within the radius is an answer.
    """
    if limit is None:
        nearest = Window.partitionBy(col(centre_id)).orderBy("distance_km", "id")
        return nearby_join(centres, plants, radius_km, centre_id).withColumn("rank", F.row_number().over(nearest))
    if limit < 1:
        raise ValueError("limit must be positive")
    return nearest_k(centres, plants, limit, _radius(radius_km), centre_id)
