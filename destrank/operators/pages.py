"""Hotel collection from crawled pages.

A search page lists hotel cards; each card links to a detail page with
the description and map coordinates. Both kinds of page are rows of a
``pages(page_id, url, html)`` table, so extraction is a projection and
merging details into the listing is a join on the stripped URL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from destrank.functions import html as H
from destrank.functions.text import join_texts, strip_query
from destrank.operators.enrich import dedup_first, detail_merge


#: Pages are numbered in crawl order.
CRAWL_ORDER = "page_id"


def listing_cards(pages: DataFrame, city: str = "city") -> DataFrame:
    """Search pages -> one row per card: (city, card_pos, name, score, url).

    Cards without a link are dropped, as the crawler follows links only. A
    ``page_id`` of the pages is passed on.
    """
    kept = [city, *[c for c in pages.columns if c == CRAWL_ORDER]]
    cards = pages.select(*kept, F.posexplode(H.blocks(H.drop_noise("html"))).alias("card_pos", "_card"))
    out = cards.select(
        *kept,
        "card_pos",
        H.testid_text("_card", H.TITLE_TESTID).alias("name"),
        H.class_text("_card", H.SCORE_CLASSES).alias("score"),
        strip_query(H.testid_attribute("_card", H.TITLE_LINK_TESTID, "href")).alias("url"),
    )
    return out.where(F.col("url").isNotNull() & (F.col("url") != ""))


def hotel_details(pages: DataFrame) -> DataFrame:
    """Detail pages -> (url, description, latitude, longitude), and the
    ``page_id`` if the pages have one."""
    body = H.drop_noise("html")
    return pages.select(
        *[c for c in pages.columns if c == CRAWL_ORDER],
        strip_query("url").alias("url"),
        join_texts(F.filter(H.testid_texts(body, H.DESCRIPTION_TESTID), lambda t: t != "")).alias("description"),
        H.map_coordinate("html", H.LATITUDE_VAR).alias("latitude"),
        H.map_coordinate("html", H.LONGITUDE_VAR).alias("longitude"),
    )


def collect_hotels(search_pages: DataFrame, detail_pages: DataFrame) -> DataFrame:
    """Cards joined with their details -> ``schemas.HOTELS`` columns.

    One row per URL: the first card in crawl order (``page_id``, then position
    on the page) with the first usable detail page. Pages without ``page_id``
    have no crawl order; the least card and the least details are taken then.
    """
    def ordered(df: DataFrame, *columns: str) -> list[str]:
        return [c for c in (CRAWL_ORDER, *columns) if c in df.columns]

    cards = listing_cards(search_pages)
    # One hotel can stand on several search pages.
    once = dedup_first(cards, ["url"], ordered(cards, "card_pos", "city", "name", "score"))
    # An error page has no details; it must not hide a good page of the same URL.
    details = hotel_details(detail_pages)
    usable = (F.col("description") != "") | F.col("latitude").isNotNull() | F.col("longitude").isNotNull()
    fields = ["description", "latitude", "longitude"]
    merged = detail_merge(once, details.where(usable), "url", ordered(details, *fields), fields)
    return merged.select("city", "name", "score", "url", *fields)


def zip_lists(names: F.Column, scores: F.Column, links: F.Column) -> F.Column:
    """Positional zip of three lists, short lists padded with NULL."""
    return F.arrays_zip(names.alias("name"), scores.alias("score"), links.alias("url"))
