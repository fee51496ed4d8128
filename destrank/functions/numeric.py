"""Number parsing and cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted numeric text, "coerce" semantics (decision SURVEY T6).
# Optional sign, digits with an optional fraction or a bare fraction, an
# optional exponent, surrounding blanks allowed. Java suffixes such as
# '1d' or '1.5f', hex, thousands separators and words stay NULL.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Signed decimal capture used for coordinates (deliberate fix, SURVEY T7).
SIGNED_NUMBER = r"(-?\d+(?:\.\d+)?)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """NaN becomes NULL, so means and sorts skip it (T2, T3); infinities are values."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def coerce_numeric(c: Column | str) -> Column:
    """Text to double, NULL for anything that is not a plain number."""
    text = _col(c).cast("string")
    parsed = F.when(text.rlike(NUMERIC_TEXT), text.try_cast("double"))
    return nan_to_null(parsed)


def capture_number(text: Column | str, pattern: str, group: int = 1) -> Column:
    """First regex capture parsed as a number; NULL when nothing matches.

    ``regexp_extract`` answers '' on a miss, which ``nullif`` turns into
    NULL before the cast.
    """
    raw = F.regexp_extract(_col(text), pattern, group)
    return coerce_numeric(F.nullif(raw, F.lit("")))


def round_nudged(c: Column | str, digits: int = 4) -> Column:
    """Round after a tiny upward nudge so values sitting exactly on a half
    round the same way in every engine (used for oracle comparison)."""
    return F.round(_col(c) + F.lit(1e-9), digits)
