"""Registered queries on the driver's tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame; the
matching SQL computes the same rows over the same parquet tables.
Averages are compared after ``round(x + 1e-9, 4)`` in both engines so
that a mean landing exactly on a half rounds alike; means that feed a
ranking are rounded before ranking for the same reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from destrank.functions import html as H
from destrank.functions.jsonx import json_field
from destrank.functions.numeric import SIGNED_NUMBER, capture_number, coerce_numeric, round_nudged
from destrank.functions.text import lookup_key, preview, search_url, strip_query, url_host
from destrank.operators import quality
from destrank.operators.enrich import (
    dedup_first,
    detail_merge,
    join_group_texts,
    lookup_first,
    zip_positions,
)
from destrank.operators.fuzzy import nearest_names
from destrank.operators.interactive import RankedLists, write_ranked_lists
from destrank.operators.nearest import nearest_places
from destrank.operators.profile import SHOWN_CHARS, column_sketches, profile
from destrank.operators.ranking import average_rank, criterion_ranks, rank_sum, weighted_score
from destrank.operators.rollup import daily_rollup, place_means, tag, union_rollups
from destrank.plans import composite, standins
from destrank.plans.standins import table
from destrank import schemas
from destrank.session import scratch_dir
from destrank.streaming import NewestForecasts, ingest_forecasts, keep_newest_forecasts
from destrank.sources import files
from destrank.sources.seed import seed_table
from destrank.sources.versions import VersionedTables
from destrank.sources.landing import flatten_forecasts, readings_for_places, responses_from_bodies

Query = Callable[[SparkSession, str], DataFrame]

MEANS = {"avg_temp_max": "temp_max", "avg_humidity": "humidity", "avg_pop": "pop"}
USER_MEANS4 = {"avg_temp_max": "temp_max", "avg_temp_min": "temp_min", "avg_humidity": "humidity", "avg_pop": "pop"}
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
FEW_VALUES = 60
SPLIT_DAY = "2024-01-16"
FEED_SCHEMA = "k bigint, user_id bigint"


def _rounded(df: DataFrame, cols) -> DataFrame:
    return df.select(*[round_nudged(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# --------------------------------------------------------------- rollups
def q_daily_rollup(spark, d):
    """A1 (A1a-d, P3, P27, T4): events as slices of an event type, one row per (type, day)."""
    readings = standins.event_readings(table(spark, d, "events"), "event_type")
    out = daily_rollup(readings, order=("ts", "event_id"))
    return _rounded(out, {"humidity"})


def _user_daily(spark, d):
    return daily_rollup(standins.event_readings(table(spark, d, "events"), "user_id"), order=("ts", "event_id"))


def q_place_means(spark, d):
    """A2: per user, the mean of the daily max/min/mean humidity/max pop."""
    return _rounded(place_means(_user_daily(spark, d), "city", USER_MEANS4), set(USER_MEANS4))


def q_union_rollups(spark, d):
    """U1 + P17: two landed batches rolled up separately (the second in another column order), unioned by name."""
    events = table(spark, d, "events")
    first = events.where(F.col("ts") < F.lit(SPLIT_DAY).cast("timestamp_ntz"))
    second = events.where(F.col("ts") >= F.lit(SPLIT_DAY).cast("timestamp_ntz"))
    a = tag(daily_rollup(standins.event_readings(first, "event_type"), order=("ts", "event_id")), "batch", "first")
    b = daily_rollup(standins.event_readings(second, "event_type"), order=("ts", "event_id"))
    # The second batch arrives in the notebook's column order, place last.
    b = tag(b.select("date", "temp_min", "temp_max", "humidity", "pop", "description", "city"), "batch", "second")
    return _rounded(union_rollups(a, b), {"humidity"})


# --------------------------------------------------------------- ranking
def _user_means(spark, d):
    return _rounded(place_means(_user_daily(spark, d), "city", MEANS), set(MEANS))


def q_average_rank(spark, d):
    """Average rank of every lineitem quantity (heavy ties)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return average_rank(li, "l_quantity", "rank_qty")


def q_average_rank_desc(spark, d):
    """Descending average rank of the per-user mean value."""
    users = table(spark, d, "events").groupBy("user_id").agg(round_nudged(F.avg("value")).alias("avg_value"))
    return average_rank(users, "avg_value", "rank_value_desc", ascending=False, checkpoint_input=True)


def q_rank_sum(spark, d):
    """Unweighted three-criterion rank sum over user means."""
    return rank_sum(_user_means(spark, d))


def q_notebook_ranking(spark, d):
    """Four means per user, three of them ranked and summed."""
    return composite.notebook_ranking(_user_daily(spark, d), "city", digits=4)


def q_weighted_score(spark, d):
    """Weighted rank score with the default weights (5, 5, 5)."""
    return weighted_score(_user_means(spark, d), (5, 5, 5))


def q_weighted_score_10_0_3(spark, d):
    """Weighted rank score with non-default weights (10, 0, 3)."""
    return weighted_score(_user_means(spark, d), (10, 0, 3))


def q_top_places(spark, d):
    """O2: the five best users by weighted score, ties by key."""
    return composite.top_places(weighted_score(_user_means(spark, d), (5, 5, 5)))


WEIGHT_SETTINGS = [(5, 5, 5), (10, 0, 3), (0, 0, 1), (1, 9, 0), (0, 0, 0)]


def q_interactive_top(spark, d):
    """C2 per slider change: five settings answered from the heads of three lists written once."""
    folder = scratch_dir(spark, "ranked-lists")
    write_ranked_lists(criterion_ranks(_user_means(spark, d)), folder)
    lists, rows = RankedLists(spark, folder), None
    for weights in WEIGHT_SETTINGS:
        best = lists.top(weights, 5).select(F.lit(str(weights)).alias("weights"), "city", "score")
        rows = best if rows is None else rows.unionByName(best)
    return rows


def _nation_top(spark, d):
    weather = standins.nation_weather(table(spark, d, "orders"), table(spark, d, "customer"))
    means = _rounded(place_means(weather, "city", MEANS), set(MEANS))
    return composite.top_places(weighted_score(means, (5, 5, 5)))


def q_top_map(spark, d):
    """The five best nations joined with their coordinates."""
    return composite.top_map(standins.nation_cities(table(spark, d, "nation")), _nation_top(spark, d))


def q_top_hotels(spark, d):
    """Suppliers in the five best nations, top 20 by coerced score."""
    hotels = standins.supplier_hotels(table(spark, d, "supplier"))
    return composite.top_hotels(hotels, _nation_top(spark, d))


def q_recommendations(spark, d):
    """C1 (A3, A4, J1, P20, O1): nation weather means joined with hotel score means."""
    weather = standins.nation_weather(table(spark, d, "orders"), table(spark, d, "customer"))
    hotels = standins.supplier_hotels(table(spark, d, "supplier"))
    out = composite.recommendations(weather, hotels)
    return _rounded(out, {"avg_temp", "avg_rain", "avg_score", "score"})


def q_preview(spark, d):
    """First five parts by key."""
    return table(spark, d, "part").orderBy("p_partkey").limit(5)


# --------------------------------------------------------- JSON sources
def q_json_field(spark, d):
    """A field of the JSON props text."""
    return table(spark, d, "events").select("event_id", json_field("props", "$.k").cast("bigint").alias("k"))


def _landed_responses(spark, d):
    """Forecast bodies written as text first, so that the JSON is really parsed."""
    path = scratch_dir(spark, "bodies")
    bodies = standins.forecast_bodies(table(spark, d, "events"))
    bodies.write.parquet(path)
    return responses_from_bodies(spark.read.schema(bodies.schema).parquet(path))


def q_forecast_flatten(spark, d):
    """Landed forecast bodies parsed and exploded, gated by located places."""
    responses = _landed_responses(spark, d)
    places = standins.customer_places(table(spark, d, "customer"))
    return readings_for_places(places, flatten_forecasts(responses))


def q_forecast_rollup(spark, d):
    """Landed forecast bodies to one weather row per place and day."""
    responses = _landed_responses(spark, d)
    places = standins.customer_places(table(spark, d, "customer"))
    return _rounded(composite.forecast_collection(places, responses), {"humidity"})


def q_forecast_ingest(spark, d):
    """C6 landing: responses landed as JSON lines, picked up by the availableNow stream, read back."""
    responses = responses_from_bodies(standins.forecast_bodies(table(spark, d, "events")))
    landing, readings = scratch_dir(spark, "landing"), scratch_dir(spark, "readings")
    files.write_json_lines(responses, landing)
    ingest_forecasts(spark, landing, readings, scratch_dir(spark, "ingest-ckpt")).awaitTermination()
    return spark.read.schema(schemas.READINGS).parquet(readings)


def q_forecast_newest(spark, d):
    """C6 without averaging old and new: two landings, the second corrects every third slice; the newest of each."""
    landing, events = scratch_dir(spark, "landing"), table(spark, d, "events")
    state = NewestForecasts(spark, scratch_dir(spark, "newest"), buckets=16)
    seen = scratch_dir(spark, "newest-ckpt")
    for part in (events.withColumn("value", F.col("value") + 1000), events.where("event_id % 3 = 0")):
        bodies = responses_from_bodies(standins.forecast_bodies(part))
        files.write_json_lines(bodies, landing, mode="append")
        keep_newest_forecasts(spark, landing, state, seen).awaitTermination()
    return state.readings()


def q_json_salvage(spark, d):
    """Objects salvaged from a concatenated-array feed and summed per user."""
    objs = files.salvage_lines(standins.feed_lines(table(spark, d, "events")), FEED_SCHEMA)
    kept = objs.where("_valid")
    return kept.groupBy("user_id").agg(F.sum("k").alias("k_sum"), F.count(F.lit(1)).alias("n_objects"))


def q_salvage_report(spark, d):
    """Kept and rejected object candidates of the feed."""
    objs = files.salvage_lines(standins.feed_lines(table(spark, d, "events")), FEED_SCHEMA)
    return objs.agg(
        F.count(F.when(F.col("_valid"), 1)).alias("kept"),
        F.count(F.when(~F.col("_valid"), 1)).alias("rejected"),
    )


# ------------------------------------------------------ numbers and text
def q_coerce_numeric(spark, d):
    """Text coerced to numbers, non-numbers to NULL."""
    part = table(spark, d, "part")
    return part.select(
        "p_partkey",
        coerce_numeric(F.split_part("p_brand", F.lit("#"), F.lit(2))).alias("brand_number"),
        coerce_numeric("p_type").alias("type_number"),
        coerce_numeric(F.col("p_retailprice").cast("string")).alias("price_number"),
    )


def q_capture_number(spark, d):
    """Numbers captured from page scripts; absent variables give NULL."""
    pages = table(spark, d, "pages")
    return pages.select(
        "page_id",
        capture_number("html", rf"track\({SIGNED_NUMBER}\)").alias("track_no"),
        H.map_coordinate("html", H.LATITUDE_VAR).alias("latitude"),
        H.map_coordinate("html", H.LONGITUDE_VAR).alias("longitude"),
    )


def q_url_strip(spark, d):
    """Page URLs up to the query string."""
    pages = table(spark, d, "pages").where(F.col("url").isNotNull() & (F.col("url") != ""))
    return pages.select("page_id", strip_query("url").alias("url"))


def q_page_links(spark, d):
    """Every link of a page, counted and listed in order."""
    pages = table(spark, d, "pages")
    hrefs = H.all_attributes(H.drop_noise("html"), "a", "href")
    return pages.select("page_id", F.size(hrefs).alias("n_links"), F.array_join(hrefs, " ").alias("links"))


def _page_fields(pages: DataFrame) -> DataFrame:
    body = H.drop_noise("html")
    return pages.select(
        "page_id",
        H.attribute("html", "html", "lang").alias("lang"),
        H.element_text(body, "title").alias("title"),
        H.element_text(body, "h1").alias("h1"),
        H.attribute(body, "a", "href").alias("first_href"),
    ).withColumn("title_preview", preview("title", 20))


def q_page_extract(spark, d):
    """Language, title, first heading and link of every page."""
    return _page_fields(table(spark, d, "pages"))


# Stand-in: the repeated-block marker of the test pages (list items).
BLOCK_MARKER = r"(?i)<li\b[^>]*>"


def q_page_blocks(spark, d):
    """P14 (per block): repeated list-item blocks with their position, link and label."""
    pages = table(spark, d, "pages")
    blocks = pages.select("page_id", F.posexplode(H.blocks(H.drop_noise("html"), BLOCK_MARKER)).alias("block_pos", "_b"))
    return blocks.select(
        "page_id",
        "block_pos",
        H.attribute("_b", "a", "href").alias("href"),
        H.element_text("_b", "a").alias("label"),
    )


def q_text_join(spark, d):
    """Conversation turns joined in order."""
    return join_group_texts(table(spark, d, "conversations"), ["conv_id"], "turn", "text")


def q_build_lookup_key(spark, d):
    """Geocoder query text and search URL per part name."""
    part = table(spark, d, "part")
    return part.select("p_partkey", lookup_key("p_name").alias("lookup_key"), search_url("p_name").alias("search_url"))


def q_zip_positions(spark, d):
    """P25: i-th user turn paired with i-th assistant turn, shorter side padded."""
    conv = table(spark, d, "conversations")
    users = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("turn").alias("user_turn"))
    assistants = conv.where(F.col("role") == "assistant").select("conv_id", "turn", F.col("turn").alias("assistant_turn"))
    return zip_positions(users, assistants, ["conv_id"], "turn", "turn", ["user_turn"], ["assistant_turn"])


# ---------------------------------------------------------------- joins
def q_geocode_left(spark, d):
    """Documents with their first label, NULL on a miss (most documents)."""
    labels = table(spark, d, "labels").select("doc_id", "quality", "toxic")
    return lookup_first(table(spark, d, "documents").select("doc_id", "lang"), labels, "doc_id", ["quality", "toxic"], ["quality", "toxic"])


def q_nearest_name(spark, d):
    """S6 / J4 by free text: every part's name misspelt, looked up among the names by edits, ties by key."""
    part = table(spark, d, "part")
    cut = (F.col("p_partkey") % F.length("p_name") + 1).cast("int")
    misspelt = F.concat(
        F.upper(F.substring("p_name", F.lit(1), cut - 1)), F.substring("p_name", cut + 1, F.length("p_name")),
        F.when(F.col("p_partkey") % 3 == 0, "x").when(F.col("p_partkey") % 7 == 0, "xyz").otherwise(""),
    )
    return nearest_names(part.select("p_partkey", misspelt.alias("text")), part, "text", "p_name", "p_partkey")


def q_nearest_place(spark, d):
    """J6 by coordinates: the nearest customer of every supplier, ties by key, with the distance."""
    suppliers = standins.spread_places(table(spark, d, "supplier"), "s_suppkey", "s_acctbal", "s_nationkey")
    customers = standins.spread_places(table(spark, d, "customer"), "c_custkey", "c_acctbal", "c_nationkey")
    found = nearest_places(suppliers, customers)
    return found.select("city", "nearest", F.round("distance_km", 3).alias("distance_km"))


def q_detail_merge(spark, d):
    """Listing rows with the details of their stripped URL."""
    pages = table(spark, d, "pages")
    listing = pages.where(F.col("url").isNotNull() & (F.col("url") != "")).select("page_id", strip_query("url").alias("url"))
    details = pages.select(
        F.col("page_id").alias("detail_page"),
        strip_query("url").alias("url"),
        H.element_text(H.drop_noise("html"), "title").alias("title"),
        capture_number("html", rf"track\({SIGNED_NUMBER}\)").alias("track_no"),
    )
    return detail_merge(listing, details, "url", ["detail_page"], ["title", "track_no"])


def q_dedup_by_url(spark, d):
    """D3: one page per host, the first by id."""
    pages = table(spark, d, "pages").select(url_host("url").alias("host"), "page_id", "url")
    return dedup_first(pages, ["host"], ["page_id"])


# -------------------------------------------------------- sources/sinks
# Stand-in: the configured list of places (event types) to process.
SEEDED_PLACES = ["view", "click", "signup", "error", "purchase"]


def q_city_seed(spark, d):
    """Readings of the configured places, counted."""
    seed = seed_table(spark, SEEDED_PLACES)
    readings = standins.event_readings(table(spark, d, "events"), "event_type")
    # The seed is a literal of known size: broadcasting it is bounded.
    kept = readings.join(F.broadcast(seed), "city", "left_semi")
    return kept.groupBy("city").agg(F.count(F.lit(1)).alias("n_readings"))


def q_sql_scan(spark, d):
    """S3: SQL text over a temporary view."""
    table(spark, d, "supplier").createOrReplaceTempView("destrank_supplier")
    return spark.sql("SELECT * FROM destrank_supplier")


def q_csv_roundtrip(spark, d):
    """Conversations (multi-line quoted text) written as CSV and read back."""
    conv = table(spark, d, "conversations")
    path = scratch_dir(spark, "csv")
    files.write_csv(conv, path)
    return files.read_csv(spark, path, conv.schema)


def q_csv_blocks(spark, d):
    """Documents written as CSV and read back by blocks, line breaks in fields and all."""
    docs = table(spark, d, "documents")
    path = scratch_dir(spark, "csv-blocks")
    files.write_csv(docs, path)
    return files.read_csv_blocks(spark, path, docs.schema)


def q_feed_objects(spark, d):
    """S5 / D2 without loss: the feed's objects by balanced braces, also those that the pattern loses, per user."""
    path = scratch_dir(spark, "feed-objects")
    standins.feed_lines(table(spark, d, "events")).write.text(path)
    found = files.feed_objects(spark, path, FEED_SCHEMA + ", note string")
    return found.groupBy("user_id", "note").agg(
        F.count(F.when(F.col("_valid"), 1)).alias("kept"), F.count(F.when(~F.col("_valid"), 1)).alias("rejected"),
        F.sum("k").alias("sum_k"),
    )


def q_json_roundtrip(spark, d):
    """K2: pages written as JSON lines and read back."""
    pages = table(spark, d, "pages")
    path = scratch_dir(spark, "json")
    files.write_json_lines(pages, path)
    return files.read_json_lines(spark, path, pages.schema)


def q_row_count_report(spark, d):
    """K6 / A5: row count per table."""
    return quality.row_counts({n: table(spark, d, n) for n in TABLES})


def q_null_audit(spark, d):
    """NULL (and NaN) count per column of documents with their labels, which most lack."""
    labels = table(spark, d, "labels").select("doc_id", "quality", "toxic")
    joined = table(spark, d, "documents").select("doc_id", "lang").join(labels, "doc_id", "left")
    return quality.null_audit(joined, table="labelled")


def q_column_profile(spark, d):
    """Every column of every table: rows, missing values, shortest and longest text, and the most
    frequent value of columns with few (where the sketches are exact)."""
    rows = None
    for name in TABLES:
        found = table(spark, d, name)
        plain = [f.name for f in found.schema if f.dataType.simpleString() in ("string", "int", "bigint")]
        told = F.coalesce(F.get("lengths", F.lit(4)), F.lit(0)) <= SHOWN_CHARS
        few = F.col("column_name").isin(plain) & F.col("n_distinct").between(1, FEW_VALUES) & told
        first = F.when(few, F.get("top_values", F.lit(0)))
        part = profile(column_sketches(found), top=1).select(
            F.lit(name).alias("table_name"), "column_name", "n_rows", F.col("n_missing").alias("null_count"),
            F.get("lengths", F.lit(0)).alias("min_length"), F.get("lengths", F.lit(4)).alias("max_length"),
            first["value"].alias("top_value"), first["n"].alias("top_count"),
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


def q_hotel_collection(spark, d):
    """Cards and details of search and detail pages derived from every page, one row per hotel."""
    pages = table(spark, d, "pages")
    return composite.hotel_collection(standins.hotel_search_pages(pages), standins.hotel_detail_pages(pages))


def q_full_batch(spark, d):
    """The whole batch; the three written tables read back, with their observed counts."""
    weather = standins.nation_weather(table(spark, d, "orders"), table(spark, d, "customer"))
    hotels = standins.supplier_hotels(table(spark, d, "supplier"))
    cities = standins.nation_cities(table(spark, d, "nation"))
    out = scratch_dir(spark, "batch")
    result = composite.run_batch(spark, weather, hotels, cities, out_dir=out)
    rows = None
    for name, key in (("recommendations", "city"), ("top_map", "city"), ("top_hotels", "name")):
        written = files.read_csv(spark, f"{out}/{name}", f"{key} string, score double").select(
            F.lit(name).alias("table_name"), F.col(key).alias("row_key"), round_nudged("score").alias("score"),
            F.lit(result.counts[name]).cast("long").alias("n_rows"),
        )
        rows = written if rows is None else rows.unionByName(written)
    return rows


def _land(df: DataFrame, folder: str) -> str:
    df.write.text(folder)
    return folder


def q_landed_batch(spark, d):
    """Landed geocodes, forecasts and hotel feed to the six tables that become current together."""
    landing = scratch_dir(spark, "landed")
    nation, supplier = table(spark, d, "nation"), table(spark, d, "supplier")
    geocodes = _land(standins.nation_geocodes(nation), f"{landing}/geocodes")
    forecasts = _land(standins.nation_forecasts(table(spark, d, "orders"), table(spark, d, "customer")), f"{landing}/forecasts")
    feed = _land(standins.supplier_feed(supplier), f"{landing}/feed")
    snapshot, _ = composite.run_landed_batch(spark, geocodes, forecasts, feed, scratch_dir(spark, "warehouse"))
    no_score, no_rank = F.lit(None).cast("double"), F.lit(None).cast("long")
    shown = {
        "cities": ("city", F.col("latitude"), no_rank),
        "weather": (F.concat_ws(" ", "city", "date"), F.col("temp_max"), no_rank),
        "hotels": ("name", F.col("score").cast("double"), no_rank),
        "city_recommendations": ("city", F.col("score"), F.col("rank")),
        "top_map": ("city", F.col("score"), no_rank),
        "top_hotels": ("name", F.col("score"), no_rank),
    }
    rows = None
    for name, (key, score, rank) in shown.items():
        part = snapshot.read(spark, name).select(
            F.lit(name).alias("table_name"), F.col(key).alias("row_key") if isinstance(key, str) else key.alias("row_key"),
            round_nudged(F.coalesce(score, no_score)).alias("score"), rank.alias("rank"),
            F.lit(snapshot.tables[name].rows).cast("long").alias("n_rows"), F.lit(snapshot.version).cast("long").alias("version"),
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


def q_tables_replaced(spark, d):
    """K4: two loads of the three tables, the second of two of them; the rows of both versions."""
    warehouse = VersionedTables(spark, scratch_dir(spark, "versions"))
    weather = standins.nation_weather(table(spark, d, "orders"), table(spark, d, "customer"))
    hotels = standins.supplier_hotels(table(spark, d, "supplier"))
    first = warehouse.replace(
        {"cities": standins.nation_cities(table(spark, d, "nation")), "weather": weather.where("pop = 1"), "hotels": hotels}
    )
    second = warehouse.replace({"weather": weather, "hotels": hotels.where(coerce_numeric("score") > 0)})
    rows = None
    for snapshot in (first, second):
        for name, key in (("cities", "city"), ("weather", "city"), ("hotels", "name")):
            part = snapshot.read(spark, name).select(
                F.lit(snapshot.version).cast("long").alias("version"), F.lit(name).alias("table_name"),
                F.lit(snapshot.tables[name].rows).cast("long").alias("n_rows"), F.col(key).alias("row_key"),
            )
            rows = part if rows is None else rows.unionByName(part)
    return rows


QUERIES: dict[str, Query] = {
    "recommendations": q_recommendations,
    "daily_rollup": q_daily_rollup,
    "place_means": q_place_means,
    "union_rollups": q_union_rollups,
    "average_rank": q_average_rank,
    "average_rank_desc": q_average_rank_desc,
    "rank_sum": q_rank_sum,
    "notebook_ranking": q_notebook_ranking,
    "weighted_score": q_weighted_score,
    "weighted_score_10_0_3": q_weighted_score_10_0_3,
    "top_places": q_top_places,
    "interactive_top": q_interactive_top,
    "top_map": q_top_map,
    "top_hotels": q_top_hotels,
    "preview": q_preview,
    "json_field": q_json_field,
    "forecast_flatten": q_forecast_flatten,
    "forecast_rollup": q_forecast_rollup,
    "forecast_ingest": q_forecast_ingest,
    "forecast_newest": q_forecast_newest,
    "json_salvage": q_json_salvage,
    "salvage_report": q_salvage_report,
    "coerce_numeric": q_coerce_numeric,
    "capture_number": q_capture_number,
    "url_strip": q_url_strip,
    "page_links": q_page_links,
    "page_extract": q_page_extract,
    "page_blocks": q_page_blocks,
    "text_join": q_text_join,
    "build_lookup_key": q_build_lookup_key,
    "zip_positions": q_zip_positions,
    "geocode_left": q_geocode_left,
    "nearest_name": q_nearest_name,
    "nearest_place": q_nearest_place,
    "detail_merge": q_detail_merge,
    "dedup_by_url": q_dedup_by_url,
    "city_seed": q_city_seed,
    "sql_scan": q_sql_scan,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_blocks": q_csv_blocks,
    "feed_objects": q_feed_objects,
    "json_roundtrip": q_json_roundtrip,
    "row_count_report": q_row_count_report,
    "null_audit": q_null_audit,
    "column_profile": q_column_profile,
    "hotel_collection": q_hotel_collection,
    "full_batch": q_full_batch,
    "landed_batch": q_landed_batch,
    "tables_replaced": q_tables_replaced,
}
