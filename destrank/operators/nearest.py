"""The nearest place of every point, by coordinates.

Points and places lie on the unit sphere in space, where neither the poles nor
the date line are special, and space is cut into cubes, each into eight smaller
ones. Only cells with more than ``CROWDED`` places are cut, down to
``MAX_LEVEL``. Every point starts with the whole space and goes down ``STEP``
levels a round: of the cells reached, those nearer than the farthest corner of
some other are kept, since every cell holds a place. What is left in the end is
a few small cells a point, whose places are measured.

No cell has all its places paired with all its points, however crowded: a
location with many places or points is one row, and a cell is cut until it has
few locations. Ties go to the smaller key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from destrank.session import checkpoint_counted, ensure_checkpoint_dir

CROWDED = 32
STEP = 2
MAX_LEVEL = 20
EARTH_KM = 6371.0088
AXES = ("x", "y", "z")


def on_sphere(lat: Column, lon: Column) -> list[Column]:
    """The place on the unit sphere as x, y, z."""
    a, b = F.radians(lat), F.radians(lon)
    return [F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)]


def _located(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Distinct locations; rows without a finite coordinate or beyond the poles have none."""
    a, b = F.col(lat).cast("double"), F.col(lon).cast("double")
    good = a.between(-90, 90) & (F.abs(b) < F.lit(float("inf")))  # NaN is greater than any number
    # The two zeros are one coordinate; adding 0.0 makes them equal.
    return df.where(good).select((a + 0.0).alias("lat"), (b + 0.0).alias("lon"), "*")


def _cells(level: int) -> list[Column]:
    """Numbers of the cell of (x, y, z) along the three axes."""
    n = float(1 << level)
    return [F.least(F.floor((F.col(c) + 1) * (n / 2)), F.lit((1 << level) - 1)).cast("long").alias(f"c{c}") for c in AXES]


def _packed(cells: list[Column]) -> Column:
    """The three numbers as one key."""
    return reduce(lambda key, c: F.shiftleft(key, 21) + c, cells).alias("cell")


def _box_distance(level: Column, farthest: bool) -> Column:
    """Squared distance of (x, y, z) to the nearest point, or the farthest
    corner, of the cell ``cell`` of ``level``."""
    side = F.lit(2.0) / F.pow(F.lit(2.0), level)
    total = F.lit(0.0)
    for i, c in enumerate(AXES):
        number = F.col("cell").bitwiseAND(F.lit((1 << 21) - 1)) if i == 2 else F.shiftright("cell", 21 * (2 - i)).bitwiseAND(F.lit((1 << 21) - 1))
        low = number * side - 1
        high = low + side
        if farthest:
            gap = F.greatest(F.abs(F.col(c) - low), F.abs(F.col(c) - high))
        else:
            gap = F.greatest(low - F.col(c), F.col(c) - high, F.lit(0.0))
        total = total + gap * gap
    return total


def _tree(places: DataFrame, crowded: int) -> tuple[list[DataFrame], DataFrame]:
    """For every round the cells (parent, cell, leaf) that it reaches, and the
    places by the leaf cell that they lie in. ``places``: lat, lon, x, y, z, key."""
    inner, rounds, leaves = places.withColumn("parent", F.lit(0).cast("long")), [], None
    for level in range(STEP, MAX_LEVEL + 1, STEP):
        there = inner.withColumn("cell", _packed(_cells(level)))
        cells = there.groupBy("parent", "cell").agg(F.count(F.lit(1)).alias("n"))
        cells = cells.select("parent", "cell", ((F.col("n") <= crowded) | F.lit(level == MAX_LEVEL)).alias("leaf")).checkpoint()
        rounds.append(cells)
        there = there.join(cells, ["parent", "cell"])
        here = there.where("leaf").select("lat", "lon", *AXES, "key", F.lit(level).alias("level"), "cell")
        leaves = here if leaves is None else leaves.unionByName(here)
        rest = there.where(~F.col("leaf")).drop("parent", "leaf").withColumnRenamed("cell", "parent")
        inner, n = checkpoint_counted(rest)
        if not n:
            break
    return rounds, leaves.checkpoint()


def nearest_places(
    points: DataFrame,
    places: DataFrame,
    key: str = "city",
    lat: str = "latitude",
    lon: str = "longitude",
    nearest: str = "nearest",
    distance: str = "distance_km",
    crowded: int = CROWDED,
) -> DataFrame:
    """``points`` with the key of the nearest of ``places`` and its distance.

    Both have columns ``lat`` and ``lon`` in degrees. Points without usable
    coordinates, or if there is no place with any, get NULLs; places without a
    key or coordinates take no part."""
    ensure_checkpoint_dir(points.sparkSession)
    sites = _located(places.select(F.col(lat), F.col(lon), F.col(key).alias("key")).where(F.col(key).isNotNull()), lat, lon)
    sites = sites.groupBy("lat", "lon").agg(F.min("key").alias("key"))
    xyz = [c.alias(a) for c, a in zip(on_sphere(F.col("lat"), F.col("lon")), AXES)]
    rounds, leaves = _tree(sites.select("lat", "lon", *xyz, "key").checkpoint(), crowded)

    asked = _located(points.select(lat, lon), lat, lon).select("lat", "lon").distinct().select("lat", "lon", *xyz)
    point = ["lat", "lon", *AXES]
    front = asked.select(*point, F.lit(0).alias("level"), F.lit(0).cast("long").alias("cell"), F.lit(False).alias("leaf")).checkpoint()
    for i, cells in enumerate(rounds):
        level = STEP * (i + 1)
        down = front.where(~F.col("leaf")).withColumnRenamed("cell", "parent").drop("leaf", "level").join(cells, "parent")
        reached = front.where("leaf").unionByName(down.withColumn("level", F.lit(level)).drop("parent"))
        reached = reached.withColumn("low", _box_distance(F.col("level"), False))
        # Rounding must not cut the nearest cell off, nor one that ties with it.
        reached = reached.withColumn("high", _box_distance(F.col("level"), True) * (1 + 1e-9) + 1e-18)
        bounds = reached.groupBy("lat", "lon").agg(F.min("high").alias("bound"))
        kept = reached.join(bounds, ["lat", "lon"]).where(F.col("low") <= F.col("bound"))
        front = kept.select(*point, "level", "cell", "leaf").checkpoint()

    site = leaves.select("level", "cell", "key", *[F.col(a).alias(f"s{a}") for a in AXES])
    square = reduce(Column.__add__, [(F.col(a) - F.col(f"s{a}")) * (F.col(a) - F.col(f"s{a}")) for a in AXES])
    best = (
        front.join(site, ["level", "cell"])
        .groupBy("lat", "lon")
        .agg(F.min(F.struct(square.alias("square"), "key")).alias("best"))
    )
    km = 2 * EARTH_KM * F.asin(F.least(F.sqrt("best.square") / 2, F.lit(1.0)))
    found = best.select(
        F.col("lat").alias("_at_lat"), F.col("lon").alias("_at_lon"), F.col("best.key").alias(nearest), km.alias(distance)
    )
    here = (F.col(lat).cast("double") + 0.0 == F.col("_at_lat")) & (F.col(lon).cast("double") + 0.0 == F.col("_at_lon"))
    return points.join(found, here, "left").select(*points.columns, nearest, distance)
