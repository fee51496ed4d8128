"""Landed forecast responses -> readings table, incrementally."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from destrank import schemas
from destrank.session import scratch_dir
from destrank.sources.landing import flatten_forecasts


def ingest_forecasts(
    spark: SparkSession,
    landing_path: str,
    readings_path: str,
    checkpoint_location: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Append the slices of newly landed responses to a parquet table.

    Returns the started query; with ``availableNow`` it stops by itself
    once every file present at start has been processed (call
    ``awaitTermination()``). Pass the same ``checkpoint_location`` on
    every run so already ingested files are skipped.
    """
    reader = spark.readStream.schema(schemas.FORECAST_RESPONSE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    readings = flatten_forecasts(reader.json(landing_path))
    return (
        readings.writeStream.format("parquet")
        .option("path", readings_path)
        .option("checkpointLocation", checkpoint_location or scratch_dir(spark, "ingest-ckpt"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
