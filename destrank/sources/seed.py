"""Literal dimension tables (e.g. the list of places to rank)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def seed_table(spark: SparkSession, values: Sequence[str], column: str = "city") -> DataFrame:
    """One-column table from a short literal list (e.g. ``fixed.PLACES``)."""
    return spark.createDataFrame([(v,) for v in values], f"{column} string")
