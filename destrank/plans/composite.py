"""The pipeline's capabilities as composable DataFrame functions.

C1 recommendations, C2 weighted ranking + top-5, C3 map table of the
best places, C4 best hotels in them, C5 unweighted ranking, C6 forecast
collection, C7 hotel collection, C8 the whole batch as one application
(`run_batch` from ready tables, `run_landed_batch` from landed files).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from destrank.fixed import DEFAULT_WEIGHTS, RAIN_WEIGHT, TOP_HOTELS, TOP_PLACES
from destrank.functions.numeric import coerce_numeric, round_nudged
from destrank.operators import quality
from destrank.operators.enrich import semi_filter
from destrank.operators.pages import collect_hotels
from destrank.operators.numbering import with_row_numbers
from destrank.operators.ranking import rank_sum, top_k, weighted_score
from destrank.operators.rollup import daily_rollup, place_means
from destrank import schemas
from destrank.plans.stages import Run, Stage, run_stages
from destrank.session import ensure_checkpoint_dir
from destrank.sources import files
from destrank.sources.landing import (
    cities_from_geocodes,
    flatten_forecasts,
    read_forecasts,
    read_geocodes,
    readings_for_places,
)
from destrank.sources.versions import Snapshot, VersionedTables



def recommendations(weather: DataFrame, hotels: DataFrame, key: str = "city") -> DataFrame:
    """Mean warmth and rain per place, mean hotel score per place,
    score = avg_temp - avg_rain * 10 + avg_score, best first.

    Places missing on either side are dropped (inner join); a place whose
    hotels carry no usable score keeps a NULL score and sorts last.
    Both sides are reduced to one row per place before the join, and the
    join reuses the aggregation's hash partitioning.
    """
    means = place_means(weather, key, {"avg_temp_max": "temp_max", "avg_pop": "pop"})
    return recommendations_from_means(means, hotels, key)


def recommendations_from_means(
    means: DataFrame,
    hotels: DataFrame,
    key: str = "city",
    temp: str = "avg_temp_max",
    rain: str = "avg_pop",
) -> DataFrame:
    """C1 from per-place means already computed (e.g. checkpointed for the
    ranking), so the readings are not aggregated a second time."""
    hotels_avg = (
        hotels.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.avg(coerce_numeric("score")).alias("avg_score"))
    )
    score = F.col("avg_temp") - F.col("avg_rain") * F.lit(RAIN_WEIGHT) + F.col("avg_score")
    return (
        means.select(key, F.col(temp).alias("avg_temp"), F.col(rain).alias("avg_rain"))
        .join(hotels_avg, key)
        .withColumn("score", score)
        .orderBy(F.col("score").desc_nulls_last(), F.col(key))
    )


def place_scores(weather: DataFrame, weights: Sequence[int] = DEFAULT_WEIGHTS, key: str = "city") -> DataFrame:
    """Per-place means, then the weighted rank score."""
    return weighted_score(place_means(weather, key), weights)


def top_places(scores: DataFrame, k: int = TOP_PLACES, key: str = "city") -> DataFrame:
    """The ``k`` best places (ties by key)."""
    return top_k(scores, k, "score", (key,))


def notebook_ranking(weather: DataFrame, key: str = "city", digits: int | None = None) -> DataFrame:
    """Unweighted rank sum over the four means (min temperature is
    reported, not ranked). ``digits`` rounds the means before ranking."""
    means = place_means(
        weather,
        key,
        {"avg_temp_max": "temp_max", "avg_temp_min": "temp_min", "avg_humidity": "humidity", "avg_pop": "pop"},
    )
    if digits is not None:
        means = means.select(key, *[round_nudged(c, digits).alias(c) for c in means.columns if c != key])
    return rank_sum(means)


def top_map(cities: DataFrame, top: DataFrame, key: str = "city") -> DataFrame:
    """Coordinates of the best places with their score.

    ``top`` is a top-k table, so broadcasting it is bounded by k rows.
    """
    return cities.join(F.broadcast(top.select(key, "score")), key).select(key, "latitude", "longitude", "score")


def top_hotels(hotels: DataFrame, top: DataFrame, k: int = TOP_HOTELS, key: str = "city") -> DataFrame:
    """C4: the ``k`` best-scored hotels located in the best places.

    Scores are coerced to numbers (text becomes NULL and sorts last);
    ties are broken by URL so the cut is deterministic.
    """
    in_top = semi_filter(hotels, top, key, bounded=True).withColumn("score", coerce_numeric("score"))
    return top_k(in_top, k, "score", ("url",)).select("name", key, "latitude", "longitude", "score")


def forecast_collection(places: DataFrame, responses: DataFrame) -> DataFrame:
    """Landed forecast responses -> one weather row per place and day."""
    readings = readings_for_places(places, flatten_forecasts(responses))
    return daily_rollup(readings).select(
        "city", "date", "temp_min", "temp_max", "humidity", "pop", "description"
    )


def hotel_collection(search_pages: DataFrame, detail_pages: DataFrame) -> DataFrame:
    """Crawled search and detail pages -> hotel rows."""
    return collect_hotels(search_pages, detail_pages)


@dataclass
class BatchResult:
    recommendations: DataFrame
    scores: DataFrame
    top_places: DataFrame
    top_map: DataFrame
    top_hotels: DataFrame
    counts: dict[str, int]


def run_batch(
    spark: SparkSession,
    weather: DataFrame,
    hotels: DataFrame,
    cities: DataFrame,
    out_dir: str | None = None,
    weights: Sequence[int] = DEFAULT_WEIGHTS,
    key: str = "city",
    write: Callable[[DataFrame, str], None] | None = None,
) -> BatchResult:
    """The scheduled batch as one application.

    The readings are aggregated once: the per-place means (one row per
    place) are checkpointed to the shared checkpoint folder and feed the
    ranking, the top-k tables and the recommendation table, so a lost
    executor never forces a recompute from the raw data. The tables are
    handed to ``write(table, name)``, or written as CSV when ``out_dir`` is
    given; the row counts come from observations on those writes.
    """
    ensure_checkpoint_dir(spark)
    # weighted_score checkpoints the per-place means (one row per place)
    # and keeps them as columns, so every table below reads that
    # checkpoint instead of the readings.
    scores = weighted_score(place_means(weather, key), weights)
    top = top_places(scores, TOP_PLACES, key).checkpoint()
    tables = {
        "recommendations": recommendations_from_means(scores, hotels, key),
        "top_map": top_map(cities, top, key),
        "top_hotels": top_hotels(hotels, top, TOP_HOTELS, key),
    }
    counts: dict[str, int] = {}
    if write is None and out_dir is not None:
        def write(df: DataFrame, name: str) -> None:
            files.write_csv(df, f"{out_dir.rstrip('/')}/{name}")
    if write is not None:
        for name, df in tables.items():
            watched, obs = quality.observed(df, name)
            write(watched, name)
            counts[name] = int(obs.get["rows"])
    return BatchResult(tables["recommendations"], scores, top, tables["top_map"], tables["top_hotels"], counts)


#: The tables that a landed batch makes current together: the loaded ones and the results.
LOADED_TABLES = ("cities", "weather", "hotels")
RESULT_TABLES = ("city_recommendations", "top_map", "top_hotels")


def landed_stages(geocodes: str, forecasts: str, feed: str, weights: Sequence[int] = DEFAULT_WEIGHTS) -> list[Stage]:
    """The stages from landed responses and the hotel feed to the result tables."""

    def scores(spark, t):
        return weighted_score(place_means(t["weather"]), weights)

    def ranked(spark, t):
        return with_row_numbers(
            recommendations_from_means(t["scores"], t["hotels"]), [F.col("score").desc_nulls_last(), F.col("city")], "rank"
        )

    return [
        Stage("cities", lambda spark, t: cities_from_geocodes(read_geocodes(spark, geocodes)), inputs=[geocodes]),
        Stage(
            "weather", lambda spark, t: forecast_collection(t["cities"], read_forecasts(spark, forecasts)),
            ["cities"], [forecasts],
        ),
        Stage("hotels", lambda spark, t: files.read_salvaged_feed(spark, feed, schemas.HOTELS), inputs=[feed]),
        Stage("scores", scores, ["weather"], params=list(weights)),
        Stage("top_places", lambda spark, t: top_places(t["scores"]), ["scores"]),
        Stage("city_recommendations", ranked, ["scores", "hotels"]),
        Stage("top_map", lambda spark, t: top_map(t["cities"], t["top_places"]), ["cities", "top_places"]),
        Stage("top_hotels", lambda spark, t: top_hotels(t["hotels"], t["top_places"]), ["hotels", "top_places"]),
    ]


def run_landed_batch(
    spark: SparkSession, geocodes: str, forecasts: str, feed: str, out_dir: str, weights: Sequence[int] = DEFAULT_WEIGHTS
) -> tuple[Snapshot, Run]:
    """C8 from landed files: every stage is kept, a rerun resumes at the first
    missing one, and at the end the loaded tables and the results become
    current together (K4). A rerun on unchanged files adds no version."""
    ensure_checkpoint_dir(spark)
    warehouse = VersionedTables(spark, out_dir)
    base = warehouse.snapshot()
    run = run_stages(spark, landed_stages(geocodes, forecasts, feed, weights), f"{out_dir.rstrip('/')}/stages")
    tables = {name: run.tables[name] for name in (*LOADED_TABLES, *RESULT_TABLES)}
    if dict(base.tables) == tables:
        return base, run
    return warehouse.commit(base, tables, {"weights": list(weights)}), run
