"""Quality rules by repetition coverage.

For every text, rolling hashes of several n-gram lengths (numpy) find the
n-grams that occurred before in the same text; the measure is the share of
word characters lying in such repeated n-grams, and in repeated lines. The
texts are measured one by one where they lie: no shuffle, and memory bounded
by one batch of rows.

Defined cases: a null or empty text has no words, measures 0 and fails the
base rule; equal lines count from the second on, lines without a word never;
repeated rows are measured each; other columns, whatever their names, are
passed on untouched; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_SPACE, WORD, fresh_name, table

#: n-gram length -> largest share of word characters in repeated n-grams that is kept.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of word characters in repeated lines that is kept.
LINE_LIMIT = 0.10
#: Repeated characters that any text may have before the limits count: one long
#: line said again, which is a large share of a short clean text.
ALLOWED_CHARS = 200
SYMBOLS = "#*$%&|<>"

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_line_chars long, dup_ngram_chars array<long>"
)

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _scatter(codes: np.ndarray) -> np.ndarray:
    """Word numbers mixed to 64 pseudo-random bits."""
    x = codes.astype(np.uint64) + _BASE
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _later(keys: np.ndarray) -> np.ndarray:
    """True where an equal key stands earlier in the array."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    out = np.zeros(len(keys), bool)
    out[order[1:]] = ranked[1:] == ranked[:-1]
    return out


def _covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """True for each of ``n`` words inside a window that begins at a marked start."""
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(starts)
    edge[at] += 1
    edge[at + length] -= 1  # starts are distinct, so are their ends
    return np.cumsum(edge[:-1]) > 0


def measure(text: str | None, lengths: tuple[int, ...] = tuple(NGRAM_LIMITS)) -> tuple:
    """The values of MEASURES for one text."""
    words = re.findall(WORD, text or "")
    n = len(words)
    if not n:
        return 0, 0, sum(map((text or "").count, SYMBOLS)), 0, 0, 0, [0] * len(lengths)
    seen: set[str] = set()
    dup_lines = dup_line_chars = 0
    for line in text.split("\n"):
        if line.strip(ASCII_SPACE):
            if line in seen:
                dup_lines += 1
                dup_line_chars += sum(map(len, re.findall(WORD, line)))
            seen.add(line)
    number: dict[str, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    sizes = np.fromiter(map(len, words), np.int64, n)
    repeat_words = 0
    if n >= 4:
        v = len(number)
        pairs = codes[:-1] * v + codes[1:]
        if v**3 >= 2**63:
            pairs, v2 = np.unique(pairs, return_inverse=True)[1], v
            triples = pairs[:-1] * v2 + codes[2:]
        else:
            triples = pairs[:-1] * v + codes[2:]
        again = _later(triples)
        if again.any():
            again = np.isin(triples, triples[again])
            repeat_words = int(_covered(again, 3, n).sum())
    dup_ngram_chars = []
    if n > lengths[0] and repeat_words:  # a repeated longer n-gram holds a repeated 3-gram
        power = np.cumprod(np.full(n, _BASE))
        back = np.cumprod(np.full(n, _BASE_INVERSE))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_scatter(codes) * power)])
        for k in lengths:
            later = _later((sums[k:] - sums[:-k]) * back[: n - k + 1]) if n > k else np.zeros(1, bool)
            if not later.any():  # then no longer n-gram repeats either
                break
            dup_ngram_chars.append(int(sizes[_covered(later, k, n)].sum()))
    dup_ngram_chars += [0] * (len(lengths) - len(dup_ngram_chars))
    return n, int(sizes.sum()), sum(map(text.count, SYMBOLS)), dup_lines, repeat_words, dup_line_chars, dup_ngram_chars


def repetition_measures(text: Column, lengths: tuple[int, ...] = tuple(NGRAM_LIMITS)) -> Column:
    """The struct MEASURES for a text column; ``lengths`` ascending."""

    @F.pandas_udf(MEASURES)
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MEASURES.split(", ")]
        for texts in batches:
            yield pd.DataFrame([measure(t, lengths) for t in texts], columns=names)

    return measured(text)


def base_failed(m: Column) -> Column:
    """Too short, or mostly words in repeated 3-word windows."""
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def kept_by_coverage(
    m: Column, limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT, allowed: int = ALLOWED_CHARS
) -> Column:
    """The method's verdict: no coverage beyond the ``allowed`` characters is
    above its limit. ``limits`` has the lengths that were measured."""

    def within(repeated: Column, limit: float) -> Column:
        return repeated - allowed <= limit * m["word_chars"]

    kept = within(m["dup_line_chars"], line_limit)
    for i, (_, limit) in enumerate(sorted(limits.items())):
        kept = kept & within(m["dup_ngram_chars"][i], limit)
    return kept


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows that the base rule or the coverage limits reject."""
    m = fresh_name(docs, "_measures")
    found = docs.withColumn(m, repetition_measures(docs[text]))
    return found.filter(~base_failed(F.col(m)) & kept_by_coverage(F.col(m))).drop(m)


def op7_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, line and repetition counts of every document, and the verdicts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = F.col("m")
    return docs.select("doc_id", repetition_measures(F.col("text")).alias("m")).select(
        "doc_id",
        *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(m).alias("base_failed"),
        (~base_failed(m) & kept_by_coverage(m)).alias("kept"),
        m["dup_line_chars"].alias("dup_line_chars"),
        m["dup_ngram_chars"].alias("dup_ngram_chars"),
    )
