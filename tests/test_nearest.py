"""The nearest place by cells of space against measuring all pairs."""

import math
import random

import pytest

from destrank.operators import nearest
from destrank.operators.nearest import nearest_places


def spot(lat, lon):
    a, b = math.radians(lat), math.radians(lon)
    return math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a)


def plain(point, places):
    if None in point or abs(point[0]) > 90 or not math.isfinite(point[1]):
        return None
    p = spot(*point)
    usable = [(k, spot(a, b)) for k, a, b in places if k and None not in (a, b) and abs(a) <= 90]
    return min(((math.dist(p, s), k) for k, s in usable), default=(0, None))


def some(seed, n):
    rng = random.Random(seed)
    spots = [
        lambda: (rng.uniform(-90, 90), rng.uniform(-180, 180)),
        lambda: (48.85 + rng.gauss(0, 1e-4), 2.35 + rng.gauss(0, 1e-4)),  # a crowded town
        lambda: (rng.choice([90.0, -90.0, 89.9999]), rng.uniform(-180, 180)),
        lambda: (rng.uniform(-60, 60), rng.choice([180.0, -180.0, 179.9999, -179.9999, 540.0])),
        lambda: (10.0, 20.0),
    ]
    return [(f"k{i:03d}", *rng.choice(spots)()) for i in range(n)]


@pytest.mark.parametrize("crowded", [nearest.CROWDED, 1])
def test_equals_brute_force(spark, crowded):
    places, points = some(1, 400), some(2, 300)
    odd = [(None, 1.0, 1.0), ("none", None, 1.0), ("pole", 91.0, 0.0)]
    asked = points + [("null", None, 3.0), ("far", 95.0, 0.0), ("inf", 1.0, float("inf")), ("zero", -0.0, 0.0), *points[:5]]
    schema = "city string, latitude double, longitude double"
    got = nearest_places(spark.createDataFrame(asked, schema), spark.createDataFrame(places + odd, schema), crowded=crowded)
    assert got.columns == ["city", "latitude", "longitude", "nearest", "distance_km"]
    rows = got.collect()
    assert len(rows) == len(asked)
    by_key = {k: (a, b) for k, a, b in places}
    for r in rows:
        want = plain((r.latitude, r.longitude), places)
        if want is None:
            assert r.nearest is None and r.distance_km is None
            continue
        here = math.dist(spot(r.latitude, r.longitude), spot(*by_key[r.nearest]))
        assert math.isclose(here, want[0], rel_tol=1e-9, abs_tol=1e-12)
        assert math.isclose(r.distance_km, 2 * nearest.EARTH_KM * math.asin(min(1, want[0] / 2)), rel_tol=1e-6, abs_tol=1e-4)


def test_ties_go_to_the_smaller_key(spark):
    schema = "city string, latitude double, longitude double"
    places = spark.createDataFrame([("b", 0.0, 1.0), ("a", 0.0, -1.0), ("d", 5.0, 5.0), ("c", 5.0, 5.0)] + [("z", 5.0, 5.0)] * 500, schema)
    points = spark.createDataFrame([("p", 0.0, 0.0), ("q", 5.1, 5.0), ("r", 0.0, 180.0)], schema)  # r: (5, 5) is 173 degrees off, the others 179
    assert {r.city: r.nearest for r in nearest_places(points, places).collect()} == {"p": "a", "q": "c", "r": "c"}


def test_without_places_or_points(spark):
    one = spark.createDataFrame([("a", 1.0, 2.0)], "city string, latitude double, longitude double")
    assert [tuple(r) for r in nearest_places(one, one.limit(0)).collect()] == [("a", 1.0, 2.0, None, None)]
    assert nearest_places(one.limit(0), one).count() == 0


def test_no_pairing_of_a_crowded_cell(spark):
    """2,000 places and 2,000 points in one street: few candidates a point are measured."""
    rng = random.Random(3)
    spots = [(f"{i}", 48.85 + rng.random() * 1e-3, 2.35 + rng.random() * 1e-3) for i in range(2000)]
    df = spark.createDataFrame(spots, "city string, latitude double, longitude double")
    got = nearest_places(df, df)
    assert got.where("city = nearest").count() == 2000
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
