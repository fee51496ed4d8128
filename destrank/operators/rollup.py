"""Rollups: readings -> one row per place and day -> one row per place.

All aggregates here are partial (map-side) aggregates, so a place that
holds a large share of the rows is reduced on every executor before the
shuffle and never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from destrank.functions.numeric import nan_to_null


def first_non_null(value: str | Column, order: Sequence[str | Column]) -> Column:
    """First non-null ``value`` in source order, order given by ``order``.

    ``min_by`` skips rows whose ordering key is NULL, so the key is only
    set where the value is present; it combines partially like ``min``.
    """
    v = F.col(value) if isinstance(value, str) else value
    key = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return F.min_by(v, F.when(v.isNotNull(), key))


def daily_rollup(
    readings: DataFrame,
    keys: Sequence[str] = ("city", "date"),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Forecast slices -> one row per (place, day).

    temp_min/temp_max = min/max of temp, humidity = mean, pop = max,
    description = first non-null in source order. Rows whose key is NULL
    are dropped and NaN measures count as missing.
    """
    rows = readings
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    temp = nan_to_null("temp")
    pop = nan_to_null("pop")
    return rows.groupBy(*keys).agg(
        F.min(temp).alias("temp_min"),
        F.max(temp).alias("temp_max"),
        F.avg(nan_to_null(F.col("humidity").cast("double"))).alias("humidity"),
        F.max(pop).alias("pop"),
        first_non_null("description", order).alias("description"),
    )


def place_means(
    weather: DataFrame,
    key: str = "city",
    measures: dict[str, str] | None = None,
) -> DataFrame:
    """Daily rows -> one row per place with the mean of each measure.

    ``measures`` maps output name -> input column; the default is the
    dashboard's (avg_temp_max, avg_humidity, avg_pop).
    """
    measures = measures or {
        "avg_temp_max": "temp_max",
        "avg_humidity": "humidity",
        "avg_pop": "pop",
    }
    return (
        weather.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.avg(nan_to_null(F.col(src).cast("double"))).alias(out) for out, src in measures.items()])
    )


def union_rollups(*frames: DataFrame) -> DataFrame:
    """Append rollups that share columns in any order (by name)."""
    if not frames:
        raise ValueError("union_rollups needs at least one frame")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def tag(df: DataFrame, column: str, value: object) -> DataFrame:
    """Constant column (e.g. the place name a per-place frame belongs to)."""
    return df.withColumn(column, F.lit(value))
