"""String, URL and text-assembly expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from destrank.fixed import LOOKUP_SUFFIX, SEARCH_URL

HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup_key(name: Column | str, suffix: str = LOOKUP_SUFFIX) -> Column:
    """Geocoder query text: place name plus a country suffix."""
    return F.concat(_col(name), F.lit(suffix))


def search_url(name: Column | str, template: str = SEARCH_URL) -> Column:
    """Search URL for a place, the name percent-encoded (spaces as %20)."""
    encoded = F.replace(F.url_encode(_col(name)), F.lit("+"), F.lit("%20"))
    return F.format_string(template, encoded)


def strip_query(url: Column | str) -> Column:
    """URL up to the first '?'."""
    return F.split_part(_col(url), F.lit("?"), F.lit(1))


def url_host(url: Column | str) -> Column:
    """Host part of an absolute URL, NULL when there is none."""
    return F.nullif(F.regexp_extract(_col(url), HOST_PATTERN, 1), F.lit(""))


def join_texts(pieces: Column | str, sep: str = " ") -> Column:
    """Join an array of text pieces; an empty or missing array gives ''."""
    return F.coalesce(F.array_join(_col(pieces), sep), F.lit(""))


def preview(c: Column | str, n: int) -> Column:
    """First ``n`` characters, for display columns only."""
    return F.substring(_col(c), 1, n)
