"""Explicit schemas of the pipeline's tables (no inference anywhere).

Column names and order follow the collection code the engine replaces;
``ts`` in ``READINGS`` is the forecast slice time kept so that "first in
source order" stays deterministic once rows are distributed.
"""

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()
L = T.LongType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


CITIES = _struct(("city", S), ("latitude", D), ("longitude", D))

GEOCODE_HIT = _struct(("lat", S), ("lon", S))
GEOCODE_RESPONSE = _struct(("city", S), ("hits", T.ArrayType(GEOCODE_HIT)))

FORECAST_ENTRY = _struct(
    ("dt_txt", S),
    ("main", _struct(("temp", D), ("humidity", L))),
    ("pop", D),
    ("weather", T.ArrayType(_struct(("description", S)))),
)
FORECAST_BODY = _struct(("list", T.ArrayType(FORECAST_ENTRY)))
FORECAST_RESPONSE = _struct(("city", S), ("list", T.ArrayType(FORECAST_ENTRY)))

READINGS = _struct(
    ("city", S), ("date", S), ("ts", S), ("temp", D), ("humidity", L), ("pop", D), ("description", S)
)

WEATHER = _struct(
    ("city", S), ("date", S), ("temp_min", D), ("temp_max", D), ("humidity", D), ("pop", D), ("description", S)
)

HOTELS = _struct(
    ("city", S), ("name", S), ("score", S), ("url", S), ("description", S), ("latitude", D), ("longitude", D)
)

RECOMMENDATIONS = _struct(("city", S), ("avg_temp", D), ("avg_rain", D), ("avg_score", D), ("score", D))
