"""Lookup by edits against measuring all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from destrank.operators import fuzzy
from destrank.operators.fuzzy import nearest_names, normalised, variants


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def changed(rng, text):
    for _ in range(rng.randint(0, 3)):
        i = rng.randint(0, len(text))
        text = rng.choice([text[:i] + text[i + 1 :], text[:i] + rng.choice("abcé") + text[i:], text[:i] + rng.choice("abc") + text[i + 1 :]])
    return text


@pytest.mark.parametrize("short", [fuzzy.SHORT_CHARS, 3])
def test_equals_brute_force(spark, monkeypatch, short):
    monkeypatch.setattr(fuzzy, "SHORT_CHARS", short)
    rng = random.Random(8)
    names = ["".join(rng.choice("abc") for _ in range(n)) for n in [*range(1, 13)] * 4 + [23, 24, 25, 26, 27, 60] * 3]
    texts = [changed(rng, rng.choice(names)) for _ in range(300)] + ["", "zzzzzzz", "a" * 90]
    known = {}
    for i, n in enumerate(names):
        known.setdefault(n, f"k{i:03d}")
    got = nearest_names(
        spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, found_at int"),
        spark.createDataFrame([(f"k{i:03d}", n) for i, n in enumerate(names)] + [(None, "abc"), ("k", None)], "key string, name string"),
        "text", "name", "key",
    ).collect()
    assert len(got) == len(texts)
    plain = str.maketrans("é", "e")
    for r in got:
        text = r.text.translate(plain)
        best = min(((edits(text, n), k) for n, k in known.items()), default=None)
        want = (best[1], best[0]) if text and best[0] <= 2 else (None, None)
        assert (r.found, r.found_edits) == want, r


def test_normalised(spark):
    rows = [(" Aix--en\tProvence ", "aix en provence"), ("Besançon", "besancon"), ("ÉZE!", "eze"), ("", None), ("--", None), (None, None), ("漢字 7", "漢字 7")]
    df = spark.createDataFrame(rows, "a string, b string").select(normalised(F.col("a")).alias("a"), "b")
    assert all(r.a == r.b for r in df.collect())


def test_variants_are_bounded(spark):
    df = spark.createDataFrame([("abc",), ("",), ("aaaa",), ("abcdefghijklmnopqrstuvwx",)], "t string")
    got = [set(r.v) for r in df.select(variants(F.col("t")).alias("v")).collect()]
    assert got[0] == {"abc", "ab", "ac", "bc", "a", "b", "c"} and got[1] == {""} and got[2] == {"aaaa", "aaa", "aa"}
    assert len(got[3]) == 1 + 24 + 24 * 23 // 2


def test_long_hot_and_missing(spark):
    texts = spark.createDataFrame([("paris",)] * 500 + [("x" * 20_000,), (None,)], "t string")
    names = spark.createDataFrame([("1", "Paris"), ("2", "PARIS"), ("3", "x" * 20_001)], "k string, n string")
    got = nearest_names(texts, names, "t", "n", "k").groupBy("found", "found_edits").count().collect()
    assert {tuple(r) for r in got} == {("1", 0, 500), ("3", 1, 1), (None, None, 1)}
    assert nearest_names(texts.limit(0), names, "t", "n", "k").count() == 0
    assert nearest_names(texts, names.limit(0), "t", "n", "k").where("found is not null").count() == 0
