"""Adapters that present the driver's tables in the pipeline's shapes.

The test tables are not travel data, so each operator plays on a
stand-in: a place is a nation, an event type or a user; readings are
events or orders; hotels are suppliers; crawled pages are ``pages``.
Every adapter is a projection or join over the given tables, so its work
grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from destrank.functions.jsonx import json_field
from destrank.functions.text import url_host

# Stand-in mapping constants (also spelled out in the oracle SQL).
RAIN_BY_STATUS = {"F": 1.0, "P": 0.5}
PRICE_SCALE = 10000.0
PRIORITY_SCALE = 20.0
POP_SCALE = 500.0
CHUNK = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nation_weather(orders: DataFrame, customer: DataFrame, *keep: str) -> DataFrame:
    """Orders as weather rows of the customer's nation.

    temp_max = total price / 10^4, humidity = priority digit * 20,
    pop = 1 for finished, 0.5 for partial, 0 for open orders.
    """
    status = F.col("o_orderstatus")
    pop = F.when(status == "F", F.lit(RAIN_BY_STATUS["F"])).when(status == "P", F.lit(RAIN_BY_STATUS["P"])).otherwise(F.lit(0.0))
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    return joined.select(
        F.col("c_nationkey").cast("string").alias("city"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        (F.col("o_totalprice") / F.lit(PRICE_SCALE)).alias("temp_max"),
        (F.substring("o_orderpriority", 1, 1).cast("int") * F.lit(PRIORITY_SCALE)).alias("humidity"),
        pop.alias("pop"),
        *keep,
    )


def supplier_hotels(supplier: DataFrame) -> DataFrame:
    """Suppliers as hotels; the score arrives as text, as crawled."""
    return supplier.select(
        F.col("s_nationkey").cast("string").alias("city"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").cast("string").alias("score"),
        F.concat(F.lit("https://hotels.example.com/"), F.col("s_suppkey").cast("string")).alias("url"),
        F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
    )


def nation_cities(nation: DataFrame) -> DataFrame:
    """Nations as places with stand-in coordinates."""
    return nation.select(
        F.col("n_nationkey").cast("string").alias("city"),
        F.col("n_regionkey").cast("double").alias("latitude"),
        F.col("n_nationkey").cast("double").alias("longitude"),
    )


def nation_geocodes(nation: DataFrame) -> DataFrame:
    """Landed geocoder responses of the nations; every seventh found nothing."""
    hit = F.struct(F.col("n_regionkey").cast("string").alias("lat"), F.col("n_nationkey").cast("string").alias("lon"))
    hits = F.when(F.col("n_nationkey") % 7 == 3, F.array().cast("array<struct<lat:string,lon:string>>")).otherwise(F.array(hit))
    return nation.select(F.to_json(F.struct(F.col("n_nationkey").cast("string").alias("city"), hits.alias("hits"))).alias("value"))


def nation_forecasts(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Landed forecast responses of the nations: their weather rows as slices,
    at most 64 orders in one response."""
    weather = nation_weather(orders.withColumn("o_chunk", F.floor(F.col("o_orderkey") / CHUNK)), customer, "o_chunk")
    entry = F.struct(
        F.concat("date", F.lit(" 00:00:00")).alias("dt_txt"),
        F.struct(F.col("temp_max").alias("temp"), F.col("humidity").cast("bigint").alias("humidity")).alias("main"),
        "pop",
        F.array(F.struct(F.lit("fair").alias("description"))).alias("weather"),
    )
    bodies = weather.groupBy("city", "o_chunk").agg(F.collect_list(entry).alias("list"))
    return bodies.select(F.to_json(F.struct("city", "list")).alias("value"))


def supplier_feed(supplier: DataFrame) -> DataFrame:
    """The hotels as a feed of concatenated arrays, one object each."""
    return supplier_hotels(supplier).select(F.concat(F.lit("["), F.to_json(F.struct("*")), F.lit("]")).alias("value"))


def event_readings(events: DataFrame, place: str) -> DataFrame:
    """Events as forecast slices of a place column (``user_id`` or ``event_type``)."""
    return events.select(
        F.col(place).cast("string").alias("city"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("ts"),
        F.col("event_id"),
        F.col("value").alias("temp"),
        json_field("props", "$.k").cast("bigint").alias("humidity"),
        (F.col("value") / F.lit(POP_SCALE)).alias("pop"),
        F.col("props").alias("description"),
    )


def forecast_bodies(events: DataFrame) -> DataFrame:
    """Landed forecast responses: per user, consecutive events grouped by
    ``event_id div 64`` into one JSON body (at most 64 slices each)."""
    entry = F.struct(
        # Microseconds keep slice times unique, so "first" stays deterministic.
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("dt_txt"),
        F.struct(
            F.col("value").alias("temp"),
            json_field("props", "$.k").cast("bigint").alias("humidity"),
        ).alias("main"),
        (F.col("value") / F.lit(POP_SCALE)).alias("pop"),
        F.array(F.struct(F.col("event_type").alias("description"))).alias("weather"),
    )
    return (
        events.select(F.col("user_id").cast("string").alias("city"), (F.col("event_id") / CHUNK).cast("long").alias("chunk"), entry.alias("e"))
        .groupBy("city", "chunk")
        .agg(F.to_json(F.struct(F.collect_list("e").alias("list"))).alias("body"))
    )


def customer_places(customer: DataFrame) -> DataFrame:
    """Customers as geocoded places (city = customer key)."""
    return customer.select(
        F.col("c_custkey").cast("string").alias("city"),
        F.col("c_acctbal").alias("latitude"),
        F.col("c_nationkey").cast("double").alias("longitude"),
    )


def spread_places(df: DataFrame, key: str, number: str, group: str) -> DataFrame:
    """Rows as places all over the globe: a balance turned into degrees."""
    return df.select(
        F.col(key).cast("string").alias("city"),
        (F.pmod(F.col(number), F.lit(180.0)) - 90).alias("latitude"),
        (F.pmod(F.col(number) * 7 + F.col(group) * 13, F.lit(360.0)) - 180).alias("longitude"),
    )


def feed_lines(events: DataFrame) -> DataFrame:
    """A hotel-feed-like text: each line one JSON array holding one object
    (the file is a concatenation of arrays). Error events carry a note
    with braces inside a string, which the object pattern cannot salvage
    (only the inner ``{error}`` fragment matches and fails to parse)."""
    note = F.when(F.col("event_type") == "error", F.lit("{error}")).otherwise(F.col("event_type"))
    extra = F.concat(F.lit(', "user_id": '), F.col("user_id").cast("string"), F.lit(', "note": "'), note, F.lit('"}'))
    obj = F.regexp_replace("props", r"\}$", extra)
    return events.select(F.concat(F.lit("["), obj, F.lit("]")).alias("value"))


def hotel_search_pages(pages: DataFrame) -> DataFrame:
    """A search page per crawled page: one card for the page's host, with a
    score on two of three, and markup with the card's attributes behind it."""
    score = F.when(F.col("page_id") % 3 != 0, F.concat(
        F.lit('<div class="x f63b14ab7a dff2e52086"><b>'), (F.col("page_id") % 10).cast("string"), F.lit(".5</b></div>")
    )).otherwise("")
    html = F.concat(
        F.lit('<html><body><div data-testid="property-card"><div><h3><a data-testid="title-link" href="https://'), url_host("url"),
        F.lit('/hotel.html?page='), F.col("page_id").cast("string"),
        F.lit('"><div data-testid="title"><div>Hotel</div> '), F.col("page_id").cast("string"), F.lit("</div></a></h3>"),
        score, F.lit('</div></div><div class="f63b14ab7a dff2e52086">9.9</div></body></html>'),
    )
    return pages.select("page_id", (F.col("page_id") % 7).cast("string").alias("city"), "url", html.alias("html"))


def hotel_detail_pages(pages: DataFrame) -> DataFrame:
    """A detail page per crawled page with a ``page`` parameter; one of four is
    an error page, and so hosts lack details or have several."""
    number = F.col("page_id").cast("string")
    html = F.when(F.col("page_id") % 4 == 0, "<html>error</html>").otherwise(F.concat(
        F.lit('<html><div data-testid="property-description">Room <b>'), number,
        F.lit("</b></div><script>b_map_center_latitude = "), number, F.lit(".25; b_map_center_longitude = -"), number, F.lit(".5;</script></html>"),
    ))
    found = pages.where(F.contains("url", F.lit("page=")))
    return found.select("page_id", F.concat(F.lit("https://"), url_host("url"), F.lit("/hotel.html?d="), number).alias("url"), html.alias("html"))
