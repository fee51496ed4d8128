"""Command-line entry: run the batch jobs with ``spark-submit`` or ``python -m``.

    python -m destrank recommend --weather W --hotels H --out O [--format jdbc ...]
    python -m destrank rank --weather W --hotels H --cities C --out O --weights 5 5 5 [--weights 10 0 3 ...]
    python -m destrank batch --weather W --hotels H --cities C --out O
    python -m destrank weather --forecasts F --geocodes G --out O   (landed JSON lines)
    python -m destrank hotels --search-pages S --detail-pages D --out O   (parquet pages)
    python -m destrank landed --geocodes G --forecasts F --feed H --out O   (landed files to all tables, resumes)

Inputs are ``parquet``, ``csv``, ``json`` paths (any Hadoop URI) or JDBC
tables (``--jdbc-url`` plus the table name as the path). CSV and JSON
are read with the fixed schemas of ``destrank.schemas``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from destrank import schemas
from destrank.operators import quality
from destrank.operators.numbering import with_row_numbers
from destrank.operators.ranking import criterion_ranks, score_from_ranks
from destrank.operators.rollup import place_means
from destrank.plans import composite
from destrank.session import checkpoint_counted, get_session
from destrank.sources import files, jdbc
from destrank.sources.landing import cities_from_geocodes, read_forecasts, read_geocodes

SCHEMAS = {"weather": schemas.WEATHER, "hotels": schemas.HOTELS, "cities": schemas.CITIES}


def _read(spark: SparkSession, args: argparse.Namespace, kind: str) -> DataFrame:
    path = getattr(args, kind)
    if args.format == "jdbc":
        if args.jdbc_split:
            parts = jdbc.modulo_predicates(args.jdbc_split, args.jdbc_partitions)
            return jdbc.read_jdbc_predicates(spark, args.jdbc_url, path, parts, _props(args))
        return jdbc.read_jdbc(spark, args.jdbc_url, table=path, properties=_props(args))
    if args.format == "csv":
        return files.read_csv_blocks(spark, path, SCHEMAS[kind], empty_is_null=True)
    if args.format == "json":
        return files.read_json_lines(spark, path, SCHEMAS[kind])
    return spark.read.parquet(path)


def _write(df: DataFrame, args: argparse.Namespace, name: str) -> None:
    if args.format == "jdbc":
        jdbc.write_jdbc(df, args.jdbc_url, name if args.out is None else f"{args.out}{name}", properties=_props(args))
    elif args.format == "csv":
        files.write_csv(df, f"{args.out.rstrip('/')}/{name}")
    elif args.format == "json":
        files.write_json_lines(df, f"{args.out.rstrip('/')}/{name}")
    else:
        df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")


def _props(args: argparse.Namespace) -> dict[str, str]:
    return json.loads(args.jdbc_properties) if args.jdbc_properties else {}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="destrank")
    parser.add_argument("command", choices=["recommend", "rank", "batch", "weather", "hotels", "landed"])
    parser.add_argument("--weather", help="daily weather table")
    parser.add_argument("--hotels", help="hotels table")
    parser.add_argument("--cities", help="places with coordinates (rank, batch)")
    parser.add_argument("--forecasts", help="landed forecast responses, JSON lines (weather, landed)")
    parser.add_argument("--geocodes", help="landed geocoder responses, JSON lines (weather, landed)")
    parser.add_argument("--feed", help="hotel feed of concatenated JSON arrays (landed)")
    parser.add_argument("--search-pages", help="crawled search pages, parquet (city, url, html) (hotels)")
    parser.add_argument("--detail-pages", help="crawled detail pages, parquet (url, html) (hotels)")
    parser.add_argument("--out", help="output folder (files) or table-name prefix (jdbc)")
    parser.add_argument("--format", choices=["parquet", "csv", "json", "jdbc"], default="parquet")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-properties", help='JSON object, e.g. {"user": "u", "driver": "org.postgresql.Driver"}')
    parser.add_argument("--jdbc-split", help="integer SQL expression that splits table reads over tasks, e.g. abs(hashtext(city))")
    parser.add_argument("--jdbc-partitions", type=int, default=64, help="tasks of a split table read")
    parser.add_argument("--weights", type=int, nargs=3, action="append", metavar=("TEMP", "RAIN", "HUMIDITY"),
                        help="criterion weights 0..10; repeat for several settings (rank ranks once)")
    args = parser.parse_args(argv)
    settings = [tuple(w) for w in (args.weights or [list(composite.DEFAULT_WEIGHTS)])]
    needed = {
        "recommend": ["weather", "hotels"],
        "rank": ["weather", "hotels", "cities"],
        "batch": ["weather", "hotels", "cities"],
        "weather": ["forecasts", "geocodes"],
        "hotels": ["search_pages", "detail_pages"],
        "landed": ["geocodes", "forecasts", "feed", "out"],
    }[args.command]
    missing = [f"--{n.replace('_', '-')}" for n in needed if not getattr(args, n)]
    if missing:
        parser.error(f"{args.command} needs {' '.join(missing)}")

    spark = get_session(app_name=f"destrank-{args.command}")
    if args.command == "weather":
        # One row per place and day; also the places table.
        # Counts (K6, D2) are observations of the write jobs: no extra pass.
        cities, n_cities = checkpoint_counted(cities_from_geocodes(read_geocodes(spark, args.geocodes)))
        _write(cities, args, "cities")
        seen = Observation("responses")
        responses = read_forecasts(spark, args.forecasts).observe(
            seen,
            F.count(F.lit(1)).alias("responses"),
            F.count(F.when(F.col("list").isNull(), 1)).alias("rejected"),
        )
        weather, written = quality.observed(composite.forecast_collection(cities, responses), "weather")
        _write(weather, args, "weather")
        print(json.dumps({"cities": n_cities, **seen.get, "weather": written.get["rows"]}))
        return
    if args.command == "hotels":
        # Cards of the search pages merged with their detail pages.
        search = spark.read.parquet(args.search_pages)
        details = spark.read.parquet(args.detail_pages)
        hotels, written = quality.observed(composite.hotel_collection(search, details), "hotels")
        _write(hotels, args, "hotels")
        print(json.dumps({"hotels": written.get["rows"]}))
        return

    if args.command == "landed":
        # C8 from landed files: a failed run is started again with the same command.
        snapshot, run = composite.run_landed_batch(
            spark, args.geocodes, args.forecasts, args.feed, args.out, weights=settings[0]
        )
        counts = {name: t.rows for name, t in snapshot.tables.items()}
        print(json.dumps({"version": snapshot.version, "computed": run.computed, **counts}))
        return

    weather = _read(spark, args, "weather")
    hotels = _read(spark, args, "hotels")
    if args.command in ("recommend", "rank"):
        if args.command == "recommend":
            # A table has no order of its own: the rank is a column (K5).
            best = composite.recommendations(weather, hotels)
            tables = {"city_recommendations": with_row_numbers(best, [F.col("score").desc_nulls_last(), F.col("city")])}
        else:
            cities = _read(spark, args, "cities")
            # Ranks do not depend on the weights: rank once, re-score per setting.
            ranks = criterion_ranks(place_means(weather)).checkpoint()
            tables = {}
            for w in settings:
                suffix = "" if len(settings) == 1 else "_" + "_".join(map(str, w))
                top = composite.top_places(score_from_ranks(ranks, w)).checkpoint()
                tables[f"top_places{suffix}"] = composite.top_map(cities, top)
                tables[f"top_hotels{suffix}"] = composite.top_hotels(hotels, top)
        counts = {}
        for name, df in tables.items():
            watched, obs = quality.observed(df, name)
            _write(watched, args, name)
            counts[name] = obs.get["rows"]
        print(json.dumps(counts))
    else:
        cities = _read(spark, args, "cities")
        result = composite.run_batch(
            spark, weather, hotels, cities, weights=settings[0], write=lambda df, name: _write(df, args, name)
        )
        print(json.dumps(result.counts))


if __name__ == "__main__":
    main()
