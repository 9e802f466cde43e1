import math
import random

import pytest

from millrace.functions.geo import bounding_box
from millrace.operators import nearest as nearest_module
from millrace.operators import proximity
from millrace.operators.nearest import nearest_k

SCHEMA = "id bigint, latitude double, longitude double"
FULL = (
    "id bigint, gppd_idnr string, name string, country_code string, country string, capacity_mw double, "
    "latitude double, longitude double, primary_fuel string"
)


def distance(a, b):
    (p1, l1), (p2, l2) = (tuple(map(math.radians, x)) for x in (a, b))
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(h)))


def cloud(seed, n):
    """Points everywhere, and many at the poles, the date line and one crowded spot."""
    r = random.Random(seed)
    points = [(math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180)) for _ in range(n)]
    points += [(r.choice([-1, 1]) * r.uniform(88, 90), r.uniform(-180, 180)) for _ in range(n // 3)]
    points += [(r.uniform(-60, 60), r.choice([-1, 1]) * r.uniform(179, 180)) for _ in range(n // 3)]
    points += [(48.85, 2.35)] * (n // 3) + [(90, 0), (-90, 10), (0, 180), (0, -180)]
    return points


@pytest.mark.parametrize("radius", [5.0, 150.0, 1200.0, 9000.0, 25000.0])
def test_join_equals_brute_force(spark, radius):
    plants, centres = cloud(1, 150), cloud(2, 30)
    found = proximity.nearby_join(
        spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(centres)], "centre_id int, centre_lat double, centre_lng double"),
        spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(plants)], SCHEMA),
        radius,
    ).select("centre_id", "id").collect()
    got = {tuple(r) for r in found}
    assert len(got) == len(found)
    sure, never = set(), set()
    for i, c in enumerate(centres):
        for j, p in enumerate(plants):
            d = distance(c, p)
            (sure if d < radius - 1e-3 else never if d > radius + 1e-3 else set()).add((i, j))
    assert sure <= got and not got & never


def test_nearest_join_trims_a_crowded_point_exactly(spark):
    plants = cloud(3, 120)
    centres = cloud(4, 12)
    c = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(centres)], "centre_id int, centre_lat double, centre_lng double")
    p = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(plants)], SCHEMA)
    got = sorted((r.centre_id, r.rank, round(r.distance_km, 1)) for r in proximity.nearest_join(c, p, 3000, 4).collect())
    expected = []
    for i, centre in enumerate(centres):
        near = sorted(d for d in (distance(centre, q) for q in plants) if d < 3000)[:4]
        expected += [(i, k + 1, round(d, 1)) for k, d in enumerate(near)]
    assert len(got) == len(expected)
    assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 0.2 for a, b in zip(got, sorted(expected)))


def full(spark, points):
    rows = [(i, f"P{i}", "n", "USA", "US", 1.0, float(a), float(b), "Coal") for i, (a, b) in enumerate(points)]
    return spark.createDataFrame(rows, FULL)


@pytest.mark.parametrize("centre", [(48.85, 2.35), (89.9, 10.0), (-90.0, 0.0), (10.0, 179.95), (0.0, -180.0)])
def test_nearby_equals_brute_force(spark, centre):
    points = cloud(5, 150)
    found = proximity.nearby(full(spark, points), *centre, radius_km=400, limit=100).collect()
    near = sorted(d for d in (distance(centre, p) for p in points) if d < 400)[:100]
    assert len(found) == len(near)
    assert all(abs(r.distance_km - d) < 1e-3 for r, d in zip(found, near))


def test_centre_on_a_plant_is_kept_and_the_radius_is_strict(spark):
    quarter = full(spark, [(0.0, 0.0), (0.0, 90.0)])
    assert [r.id for r in proximity.nearby(quarter, 0.0, 0.0, radius_km=6371 * math.pi / 2).collect()] == [0]
    assert proximity.nearby(quarter, 0.0, 0.0).collect()[0].distance_km == pytest.approx(0, abs=1e-3)


def test_defaults_and_limits(spark):
    many = full(spark, [(0.0, i / 1000) for i in range(150)])
    assert len(proximity.nearby(many, 0.0, 0.0).collect()) == 20
    assert len(proximity.nearby(many, 0.0, 0.0, radius_km=0, limit=0).collect()) == 20
    assert len(proximity.nearby(many, 0.0, 0.0, radius_km=float("nan"), limit=500).collect()) == 100
    with pytest.raises(ValueError):
        proximity.nearby(many, float("nan"), 0.0)


def test_box_of_a_circle_over_the_pole_or_date_line_is_open():
    assert bounding_box(89.5, 0, 100)[2:] == (None, None)
    assert bounding_box(0, 179.9, 100)[2:] == (None, None)
    south, north, west, east = bounding_box(60, 10, 100)
    assert south < 59.11 and north > 60.89 and east - 10 > 1.79


def test_box_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "plants")
    full(spark, [(1.0, 1.0)]).selectExpr(
        "id", "gppd_idnr", "name", "country_code", "country", "capacity_mw", "primary_fuel",
        "CAST(latitude AS decimal(10,6)) latitude", "CAST(longitude AS decimal(11,6)) longitude",
    ).write.parquet(path)
    plan = proximity.nearby(spark.read.parquet(path), 1.0, 1.0)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(latitude" in scan and "LessThanOrEqual(longitude" in scan


CENTRES = "centre_id int, centre_lat double, centre_lng double"


def nearest(points, centre, k, radius=math.inf):
    return sorted(d for d in (distance(centre, q) for q in points) if d < radius)[:k]


@pytest.mark.parametrize("k,radius", [(1, math.inf), (4, math.inf), (500, math.inf), (5, 700.0)])
def test_nearest_k_equals_brute_force(spark, k, radius):
    r = random.Random(k)
    plants = cloud(6, 150) + [(r.gauss(40, 1e-4), r.gauss(-70, 1e-4)) for _ in range(80)]
    centres = cloud(7, 20) + [(40.0, -70.0), (41.0, -71.0), (-40.0, 110.0)]
    c = spark.createDataFrame([*[(i, *map(float, p)) for i, p in enumerate(centres)], (99, None, 1.0)], CENTRES)
    p = spark.createDataFrame([*[(i, *map(float, q)) for i, q in enumerate(plants)], (-1, 1.0, None)], SCHEMA)
    got = sorted((x.centre_id, x.rank, x.distance_km) for x in nearest_k(c, p, k, radius).collect())
    expected = sorted((i, n + 1, d) for i, centre in enumerate(centres) for n, d in enumerate(nearest(plants, centre, k, radius)))
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert all(abs(g[2] - e[2]) < 0.01 for g, e in zip(got, expected))


def test_pairs_are_a_small_multiple_of_k(spark):
    """Open land, a city seen from afar and from inside, and one point with thousands of plants."""
    r = random.Random(9)
    land = [(math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180)) for _ in range(3000)]
    city = [(r.gauss(48.85, 0.05), r.gauss(2.35, 0.05)) for _ in range(6000)]
    plants = land + city + [(0.0, 100.0)] * 3000
    centres = land[:100] + city[:100] + [(49.5, 2.35), (48.0, 2.0), (0.0, 100.0), (0.0, 100.01)]
    c = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(centres)], CENTRES)
    p = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(plants)], SCHEMA)
    cells = []
    made = nearest_module.candidate_cells

    def seen(*args):
        cells.append(made(*args))
        return cells[0]

    nearest_module.candidate_cells = seen
    try:
        got = nearest_k(c, p, 8).collect()
    finally:
        nearest_module.candidate_cells = made
    assert len(got) == 8 * len(centres)
    formed = {x["_centre"]: x["pairs"] for x in cells[0].groupBy("_centre").agg({"n": "sum"}).toDF("_centre", "pairs").collect()}
    assert len(formed) == len(centres) and max(formed.values()) <= nearest_module.CROWD * 8


def test_nearest_k_of_nothing(spark):
    c, p = spark.createDataFrame([(1, 1.0, 1.0)], CENTRES), spark.createDataFrame([(1, 1.0, 1.0)], SCHEMA)
    assert nearest_k(c.limit(0), p, 3).collect() == [] == nearest_k(c, p.limit(0), 3).collect()
    assert nearest_k(c, p, 3, 5.0).count() == 1
    with pytest.raises(ValueError):
        nearest_k(c, p, 0)
