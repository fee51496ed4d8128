"""Lookup of free text: the key whose name is nearest to it in edits.

Names and texts are normalised (case, accents, punctuation, spaces) and each
distinct one is looked up once. Two texts within ``MAX_EDITS`` = 2 edits share

- a variant with at most two characters deleted, if they are short;
- one of three segments of the longer-lived name, moved by at most two places,
  if they are long (two edits leave one segment untouched).

So names are indexed by their variants or segments, texts are joined to the
index on equal ones, and every candidate is measured. No pair within two edits
is missed, and a text has a bounded number of variants whatever its length.
The best candidate is that of fewest edits, then the smallest key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_EDITS = 2
#: Texts of at most so many characters go by deletions (300 variants at most), longer ones by segments.
SHORT_CHARS = 24
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def normalised(text: Column) -> Column:
    """Lower case, no accents, runs of anything but letters and digits as one
    space; NULL if nothing is left."""
    plain = F.translate(F.lower(text), ACCENTED, PLAIN)
    return F.nullif(F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " ")), F.lit(""))


def _without_one(text: Column) -> Column:
    """The text with each of its characters deleted; none if it is empty."""
    places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))


def variants(text: Column) -> Column:
    """The text with none, one or two characters deleted, each once."""
    one = F.array_distinct(_without_one(text))
    return F.array_distinct(F.concat(F.array(text), one, F.flatten(F.transform(one, _without_one))))


def _segments(length: Column) -> list[tuple[Column, Column]]:
    """(start from 0, size) of the three segments of a text of this length."""
    size = F.floor(length / 3).cast("int")
    return [(F.lit(0), size), (size, size), (2 * size, length - 2 * size)]


def own_segments(text: Column) -> Column:
    """Length, number and text of each of the three segments."""
    parts = [
        F.concat_ws(":", F.length(text), F.lit(i), F.substring(text, start + 1, size))
        for i, (start, size) in enumerate(_segments(F.length(text)))
    ]
    return F.array(*parts)


def possible_segments(text: Column) -> Column:
    """The segments that a name within two edits of the text may have."""
    moves = F.array(*[F.lit(m) for m in range(-MAX_EDITS, MAX_EDITS + 1)])

    def moved(length: Column, i: int, start: Column, size: Column) -> Column:
        there = F.filter(moves, lambda m: (start + m >= 0) & (start + m + size <= F.length(text)))
        return F.transform(there, lambda m: F.concat_ws(":", length, F.lit(i), F.substring(text, start + m + 1, size)))

    found = []
    for more in range(-MAX_EDITS, MAX_EDITS + 1):
        length = F.length(text) + more
        found += [moved(length, i, start, size) for i, (start, size) in enumerate(_segments(length))]
    return F.array_distinct(F.flatten(F.array(*found)))


def nearest_names(texts: DataFrame, names: DataFrame, text: str, name: str, key: str, found: str = "found") -> DataFrame:
    """``texts`` with the best key within two edits and the number of edits
    (``found`` and ``found_edits``); NULL where no name is as near.

    Texts without a letter or digit find nothing, and so do names and keys that
    are NULL."""
    known = names.select(F.col(key).alias("key"), normalised(F.col(name)).alias("name"))
    known = known.where(F.col("key").isNotNull() & F.col("name").isNotNull()).groupBy("name").agg(F.min("key").alias("key"))
    asked = texts.select(normalised(F.col(text)).alias("asked")).where(F.col("asked").isNotNull()).distinct()

    size, length = F.length("asked"), F.length("name")
    by_deletion = _candidates(
        asked.where(size <= SHORT_CHARS), variants(F.col("asked")),
        known.where(length <= SHORT_CHARS + MAX_EDITS), variants(F.col("name")),
    )
    by_segment = _candidates(
        asked.where(size > SHORT_CHARS), possible_segments(F.col("asked")),
        known.where(length > SHORT_CHARS - MAX_EDITS), own_segments(F.col("name")),
    )
    edits = F.levenshtein("asked", "name", MAX_EDITS)
    best = (
        by_deletion.unionByName(by_segment)
        .withColumn("edits", edits)
        .where(F.col("edits") >= 0)
        .groupBy("asked")
        .agg(F.min(F.struct("edits", "key")).alias("best"))
        .select("asked", F.col("best.key").alias("_key"), F.col("best.edits").alias("_edits"))
    )
    joined = texts.join(best, normalised(texts[text]) == best["asked"], "left")
    return joined.select(*[texts[c] for c in texts.columns], F.col("_key").alias(found), F.col("_edits").alias(f"{found}_edits"))


def _candidates(asked: DataFrame, of_asked: Column, known: DataFrame, of_known: Column) -> DataFrame:
    probes = asked.select("asked", F.explode(of_asked).alias("shared"))
    index = known.select("name", "key", F.explode(of_known).alias("shared"))
    return probes.join(index, "shared").select("asked", "name", "key").distinct()
