"""The nearest plants of very many centres, by descending a tree of cell counts.

Points of the unit sphere fall into the cells of a cube that is halved along each axis
again and again, so poles and date line are places like any other.  A centre starts with
the occupied cells of a coarse level.  The numbers of points in them, taken by largest
possible distance, bound the distance of its k-th neighbour; cells beyond that bound are
dropped and the others opened, until few points are left to compare.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.functions.geo import EARTH_RADIUS_KM, great_circle_km
from millrace.sources.workspace import materialize

#: Halvings of the cube: cells of the last level are less than a metre wide.
LEVELS = 24
#: Halvings from one round to the next.
STEP = 2
#: Centres whose cells hold at most so many points per neighbour wanted are ready to compare.
CROWD = 6
#: Chord length far above the rounding of the distance formula, about 1.3 m.
SLACK = 2e-7

AXES = ("x", "y", "z")


def _position(lat: Column, lng: Column) -> list[Column]:
    p, o = F.radians(lat.cast("double")), F.radians(lng.cast("double"))
    return [F.cos(p) * F.cos(o), F.cos(p) * F.sin(o), F.sin(p)]


def _cell(coordinate: Column) -> Column:
    side = 1 << LEVELS
    return F.least(F.lit(side - 1), F.floor((coordinate + 1) * (side / 2)).cast("int"))


def _counts(points: DataFrame, level: int) -> DataFrame:
    """Points per occupied cell of a level, with the cell's parent of the round before."""
    down = LEVELS - level
    cells = points.groupBy(*[F.shiftright(f"_{a}", down).alias(a) for a in AXES]).agg(F.count(F.lit(1)).alias("n"))
    return cells.select(*AXES, "n", *[F.shiftright(a, STEP).alias(f"up_{a}") for a in AXES])


def _bounds(level: int) -> tuple[Column, Column]:
    """Smallest and largest chord from a centre to its cell."""
    side = 2.0 / (1 << level)
    near, far = [], []
    for a in AXES:
        low = F.col(a) * side - 1.0
        high = low + side
        c = F.col(f"c{a}")
        near.append(F.greatest(low - c, c - high, F.lit(0.0)))
        far.append(F.greatest(F.abs(c - low), F.abs(c - high)))
    return tuple(F.sqrt(sum((v * v for v in vs[1:]), vs[0] * vs[0])) for vs in (near, far))


def candidate_cells(centres: DataFrame, points: DataFrame, k: int, radius_km: float) -> DataFrame:
    """``_centre``, ``level`` and the cells that hold its ``k`` nearest points, with their number ``n``.

    Each round reads the points' cell numbers and one row per centre and open cell.
    """
    reach = 2 * math.sin(min(radius_km / EARTH_RADIUS_KM, math.pi) / 2)
    # All centres start with every cell of the first level, 64 of them.
    numbers = F.explode(F.sequence(F.lit(0), F.lit((1 << 3 * STEP) - 1)))
    open_cells = centres.withColumn("_at", numbers).select(
        "_centre", *[f"c{a}" for a in AXES], *[F.shiftright("_at", STEP * i).bitwiseAND(F.lit((1 << STEP) - 1)).alias(a) for i, a in enumerate(AXES)]
    )
    found = None
    by_centre = Window.partitionBy("_centre")
    outward = by_centre.orderBy("far", *AXES).rowsBetween(Window.unboundedPreceding, 0)
    for level in range(STEP, LEVELS + 1, STEP):
        near, far = _bounds(level)
        cells = open_cells.join(_counts(points, level), [a if level == STEP else f"up_{a}" for a in AXES])
        cells = cells.withColumns({"near": near, "far": far}).where(F.col("near") <= reach + SLACK)
        enough = F.when(F.sum("n").over(outward) >= k, F.col("far"))
        bound = F.min("bound").over(by_centre)
        cells = cells.withColumn("bound", enough).withColumn("bound", F.coalesce(bound, F.lit(4.0)))
        kept = cells.where(F.col("near") <= F.col("bound") + SLACK).withColumn("left", F.sum("n").over(by_centre))
        if level == STEP:
            # Too coarse to stop at, so not worth storing.
            open_cells = kept.select("_centre", *[f"c{a}" for a in AXES], *[F.col(a).alias(f"up_{a}") for a in AXES])
            continue
        ready = (F.col("left") <= CROWD * k) | F.lit(level == LEVELS)
        kept = kept.select("_centre", *[f"c{a}" for a in AXES], *AXES, "n", ready.alias("ready"))
        kept = materialize(kept, "cells", partition_by=["ready"])
        done = kept.where("ready").select("_centre", F.lit(level).alias("level"), *AXES, "n")
        found = done if found is None else found.unionByName(done)
        rest = kept.where("NOT ready")
        if rest.isEmpty():
            break
        open_cells = rest.select("_centre", *[f"c{a}" for a in AXES], *[F.col(a).alias(f"up_{a}") for a in AXES])
    return found


def nearest_k(
    centres: DataFrame,
    plants: DataFrame,
    k: int,
    radius_km: float = math.inf,
    centre_id: str = "centre_id",
    centre_lat: str = "centre_lat",
    centre_lng: str = "centre_lng",
) -> DataFrame:
    """The ``k`` nearest plants of every centre, strictly inside the radius if one is given, ranked.

    Exact, ties by id.  Pairs are formed only with the points of a centre's candidate cells,
    a small multiple of ``k`` per centre whatever the density around it.  Plants at one and
    the same point are equally far from any centre, so at most ``k`` of them, by id, take
    part.  Rows of one centre id are ranked together with their own distances, as one centre
    given twice would be; rows without coordinates have no distance and are left out.
    """
    if k < 1:
        raise ValueError("k must be positive")
    here = Window.partitionBy("latitude", "longitude").orderBy("id")
    placed = plants.where("latitude IS NOT NULL AND longitude IS NOT NULL").withColumn("_place", F.row_number().over(here))
    where = _position(col("latitude"), col("longitude"))
    points = placed.where(F.col("_place") <= k).drop("_place").withColumns({f"_{a}": _cell(v) for a, v in zip(AXES, where)})
    points = materialize(points, "points")
    known = centres.where(col(centre_lat).isNotNull() & col(centre_lng).isNotNull())
    at = _position(col(centre_lat), col(centre_lng))
    numbered = known.withColumns({"_centre": F.monotonically_increasing_id()} | {f"c{a}": v for a, v in zip(AXES, at)})
    numbered = materialize(numbered, "centres")
    cells = candidate_cells(numbered.select("_centre", *[f"c{a}" for a in AXES]), points, k, radius_km)
    pairs = numbered.drop(*[f"c{a}" for a in AXES]).join(_paired(cells, points), "_centre")
    distance = great_circle_km(col(centre_lat), col(centre_lng), col("latitude"), col("longitude"))
    measured = pairs.drop("_centre").withColumn("distance_km", distance)
    if radius_km != math.inf:
        measured = measured.where(F.col("distance_km") < radius_km)
    order = Window.partitionBy(col(centre_id)).orderBy("distance_km", "id")
    return measured.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _paired(cells: DataFrame, points: DataFrame) -> DataFrame:
    """The points of each centre's cells; one join for every level that a centre stopped at."""
    used = sorted(r["level"] for r in cells.select("level").distinct().collect())
    out = None
    for level in used:
        at = cells.where(F.col("level") == level).select("_centre", *[F.col(a).alias(f"at_{a}") for a in AXES])
        keyed = points.withColumns({f"at_{a}": F.shiftright(f"_{a}", LEVELS - level) for a in AXES})
        part = keyed.join(at, [f"at_{a}" for a in AXES]).drop(*[f"at_{a}" for a in AXES], *[f"_{a}" for a in AXES])
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = points.drop(*[f"_{a}" for a in AXES]).withColumn("_centre", F.lit(None).cast("bigint")).limit(0)
    return out
