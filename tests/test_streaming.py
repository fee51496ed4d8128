"""Incremental ingestion: each run appends only newly landed responses."""

import json

from destrank import schemas
from destrank.operators.rollup import daily_rollup
from destrank.session import scratch_dir
from destrank.streaming import ingest_forecasts


def _response(city, day, temps):
    return {
        "city": city,
        "list": [
            {"dt_txt": f"{day} {h:02d}:00:00", "main": {"temp": t, "humidity": 50}, "pop": 0.1,
             "weather": [{"description": f"d{h}"}]}
            for h, t in zip(range(0, 24, 3), temps)
        ],
    }


def _land(spark, path, responses):
    lines = [(json.dumps(r),) for r in responses]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(path)


def test_incremental_ingest(spark):
    landing = scratch_dir(spark, "landing")
    readings = scratch_dir(spark, "readings")
    ckpt = scratch_dir(spark, "ingest")
    _land(spark, landing, [_response("A", "2026-06-03", [10.0, 12.0]), _response("B", "2026-06-03", [20.0])])
    ingest_forecasts(spark, landing, readings, ckpt).awaitTermination()
    first = spark.read.schema(schemas.READINGS).parquet(readings)
    assert first.count() == 3
    _land(spark, landing, [_response("A", "2026-06-04", [5.0])])
    ingest_forecasts(spark, landing, readings, ckpt).awaitTermination()
    both = spark.read.schema(schemas.READINGS).parquet(readings)
    assert both.count() == 4  # the first files were not read again
    daily = {(r.city, r.date): (r.temp_min, r.temp_max) for r in daily_rollup(both).collect()}
    assert daily == {("A", "2026-06-03"): (10.0, 12.0), ("B", "2026-06-03"): (20.0, 20.0), ("A", "2026-06-04"): (5.0, 5.0)}
