"""Field extraction from crawled HTML with fixed-template expressions.

Pages are rows of a ``pages`` table, so extraction is a projection that
runs in whole-stage code on every executor. Script, style and comment
bodies are removed first: scripts may hold markup inside string literals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from destrank.fixed import (  # noqa: F401  (re-exported for callers)
    CARD_TESTID,
    DESCRIPTION_TESTID,
    LATITUDE_VAR,
    LONGITUDE_VAR,
    SCORE_CLASSES,
    TITLE_LINK_TESTID,
    TITLE_TESTID,
)

NOISE = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
TAG = r"<[^>]*>"

# Entity replacements (own choice, SURVEY T15), applied in this order ('&amp;' last).
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
]

CARD_MARKER = rf'(?i)<[a-z0-9]+[^>]*data-testid="{CARD_TESTID}"[^>]*>'


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_noise(html: Column | str) -> Column:
    return F.regexp_replace(_col(html), NOISE, "")


def decode_entities(text: Column | str) -> Column:
    out = _col(text)
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def clean_text(fragment: Column | str) -> Column:
    """Markup fragment -> text: tags stripped, entities decoded, trimmed."""
    text = decode_entities(F.regexp_replace(_col(fragment), TAG, ""))
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _first(html: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


def _inner(rest: Column, name: Column | str) -> Column:
    """Content of an element ``name`` whose start tag ends where ``rest`` begins.

    ``rest`` is cut at the end tags of that name. The element's own end is the
    first one before which as many elements of the name were opened as closed;
    an element that is never closed runs to the end.
    """
    name = F.lit(name) if isinstance(name, str) else name
    opening = F.concat(F.lit("(?i)<"), name, F.lit(r"(?=[\s>])[^>]*(?<!/)>"))
    parts = F.split(rest, F.concat(F.lit("(?i)</"), name, F.lit(r"\s*>")))
    opened = F.transform(parts, lambda part: F.regexp_count(part, opening))
    start = F.struct(F.lit(0).alias("opened"), F.lit(0).alias("closed"), F.lit(None).cast("int").alias("end"))

    def step(seen: Column, n: Column) -> Column:
        total = seen["opened"] + n
        end = F.coalesce(seen["end"], F.when(total == seen["closed"], seen["closed"] + 1))
        return F.struct(total.alias("opened"), (seen["closed"] + 1).alias("closed"), end.alias("end"))

    end = F.aggregate(opened, start, step, lambda seen: seen["end"])
    held = F.slice(parts, 1, F.coalesce(end, F.size(parts)))
    return F.call_function("array_join", held, F.concat(F.lit("</"), name, F.lit(">")))


def _first_inner(html: Column, opening: str, name: Column | str) -> Column:
    """Content of the first element whose start tag matches ``opening``."""
    return F.nullif(_inner(F.get(F.split(html, opening, 2), 1), name), F.lit(""))


def element_text(html: Column | str, tag: str) -> Column:
    """Text of the first ``<tag>`` element (nested markup stripped)."""
    return clean_text(_first_inner(_col(html), rf"(?is)<{tag}\b[^>]*>", tag))


def attribute(html: Column | str, tag: str, attr: str) -> Column:
    """Value of ``attr`` on the first ``<tag>`` carrying it."""
    return _first(_col(html), rf'(?is)<{tag}\b[^>]*?\s{attr}\s*=\s*"([^"]*)"')


def all_attributes(html: Column | str, tag: str, attr: str) -> Column:
    """Every value of ``attr`` on ``<tag>`` elements, in document order."""
    return F.regexp_extract_all(_col(html), F.lit(rf'(?is)<{tag}\b[^>]*?\s{attr}\s*=\s*"([^"]*)"'), F.lit(1))


def _testid_opening(testid: str) -> str:
    return rf'(?is)<([a-z0-9]+)\b[^>]*data-testid="{testid}"[^>]*>'


def testid_text(html: Column | str, testid: str) -> Column:
    """Text of the first element whose ``data-testid`` equals ``testid``
    (all nested text, tags stripped; SURVEY T15)."""
    opening = _testid_opening(testid)
    return clean_text(_first_inner(_col(html), opening, F.regexp_extract(_col(html), opening, 1)))


def testid_texts(html: Column | str, testid: str) -> Column:
    """Texts of every element with that ``data-testid``, in order."""
    return F.transform(blocks(html, _testid_opening(testid)), clean_text)


def testid_attribute(html: Column | str, testid: str, attr: str) -> Column:
    """``attr`` of the first element with that ``data-testid``."""
    pattern = rf'(?is)<[a-z0-9]+\b(?:[^>]*\s)?data-testid="{testid}"[^>]*?\s{attr}="([^"]*)"'
    direct = _first(_col(html), pattern)
    swapped = rf'(?is)<[a-z0-9]+\b[^>]*?\s{attr}="([^"]*)"[^>]*data-testid="{testid}"'
    return F.coalesce(direct, _first(_col(html), swapped))


def class_text(html: Column | str, classes: tuple[str, ...]) -> Column:
    """Text of the first element whose class list holds all ``classes``
    (any order, other classes allowed; SURVEY T14), nested text included."""
    c = _col(html)
    held = "".join(rf'(?=[^>]*\sclass="(?:[^"]*\s)?{name}(?:\s[^"]*)?")' for name in classes)
    opening = rf"(?is)<([a-z0-9]+)\b{held}[^>]*>"
    return F.nullif(clean_text(_first_inner(c, opening, F.regexp_extract(c, opening, 1))), F.lit(""))


def blocks(html: Column | str, marker: str = CARD_MARKER) -> Column:
    """Repeated blocks: from each marker (a start tag) to the end of its
    element, at most to the next marker.

    So a card that lacks a field takes none from the next card nor from the
    rest of the page, and per-card fields stay aligned (SURVEY T16).
    """
    c = _col(html)
    parts = F.split(c, marker)
    tags = F.regexp_extract_all(c, F.lit(marker), F.lit(0))
    names = F.transform(tags, lambda t: F.regexp_extract(t, r"^<([A-Za-z0-9]+)", 1))
    return F.zip_with(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), names, _inner)


def map_coordinate(html: Column | str, var: str) -> Column:
    """Signed number assigned to a script variable, e.g. ``x = -2.02;``."""
    from destrank.functions.numeric import SIGNED_NUMBER, capture_number

    return capture_number(_col(html), rf"{var}\s*=\s*{SIGNED_NUMBER}")
