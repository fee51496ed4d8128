"""JSON access and salvage expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from destrank.fixed import OBJECT_PATTERN  # SURVEY S5, T8


def json_field(text: Column | str, path: str) -> Column:
    """Value at a JSON path of a JSON text column, as text."""
    c = F.col(text) if isinstance(text, str) else text
    return F.get_json_object(c, path)


def salvage_objects(text: Column | str) -> Column:
    """All brace-delimited object candidates in a text, in order."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(c, F.lit(OBJECT_PATTERN), F.lit(0))
