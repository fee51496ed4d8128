"""Pure ``Column -> Column`` building blocks (all JVM-side built-ins)."""

from destrank.functions.numeric import (
    capture_number,
    coerce_numeric,
    nan_to_null,
    round_nudged,
)
from destrank.functions.text import (
    join_texts,
    lookup_key,
    preview,
    search_url,
    strip_query,
    url_host,
)
from destrank.functions.jsonx import json_field, salvage_objects
from destrank.functions import html

__all__ = [
    "capture_number",
    "coerce_numeric",
    "nan_to_null",
    "round_nudged",
    "join_texts",
    "lookup_key",
    "preview",
    "search_url",
    "strip_query",
    "url_host",
    "json_field",
    "salvage_objects",
    "html",
]
