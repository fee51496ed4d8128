"""Landed API responses -> tables.

The collection side lands each geocoder and forecast response as one
JSON line tagged with the place it was requested for. Reading those
files with a fixed schema and exploding the nested arrays replaces the
per-place request loops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from destrank import schemas
from destrank.functions.numeric import coerce_numeric


def read_forecasts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FORECAST_RESPONSE).json(path)


def read_geocodes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GEOCODE_RESPONSE).json(path)


def parse_forecast(text: Column | str) -> Column:
    """Parse a forecast response body held as JSON text -> struct(list)."""
    return F.from_json(F.col(text) if isinstance(text, str) else text, schemas.FORECAST_BODY)


def responses_from_bodies(bodies: DataFrame, key: str = "city", body: str = "body") -> DataFrame:
    """(place, JSON body) rows -> ``schemas.FORECAST_RESPONSE`` rows."""
    return bodies.select(F.col(key).alias("city"), parse_forecast(body)["list"].alias("list"))


def flatten_forecasts(responses: DataFrame, *keep: str) -> DataFrame:
    """One reading per forecast slice (``schemas.READINGS``), with the columns
    ``keep`` of its response.

    A response without ``list`` (an error body) gives no rows; an entry
    with an empty ``weather`` array gives a NULL description.
    """
    e = F.col("_e")
    return responses.select("city", *keep, F.explode("list").alias("_e")).select(
        F.col("city"),
        F.substring(e["dt_txt"], 1, 10).alias("date"),
        e["dt_txt"].alias("ts"),
        e["main"]["temp"].alias("temp"),
        e["main"]["humidity"].alias("humidity"),
        e["pop"].alias("pop"),
        F.get(e["weather"], 0)["description"].alias("description"),
        *keep,
    )


def rejected_forecasts(responses: DataFrame) -> DataFrame:
    """Responses that carried no forecast list (counted, not raised)."""
    return responses.where(F.col("list").isNull())


def cities_from_geocodes(responses: DataFrame) -> DataFrame:
    """First hit per place -> (city, latitude, longitude); NULLs on no hit."""
    hit = F.get(F.col("hits"), 0)
    return responses.select(
        "city",
        coerce_numeric(hit["lat"]).alias("latitude"),
        coerce_numeric(hit["lon"]).alias("longitude"),
    )


def readings_for_places(places: DataFrame, readings: DataFrame) -> DataFrame:
    """Keep readings of places that have coordinates."""
    located = places.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select("city")
    return readings.join(located, "city", "left_semi")
