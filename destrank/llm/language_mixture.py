"""Multilingual mixture inference.

A text is a mixture of languages: each of its letter n-grams was drawn from
one language with probability equal to that language's proportion. Expectation
maximisation over the n-gram likelihoods estimates the proportions; sets of
languages are compared by penalised likelihood (BIC), and the set with the
best value gives the mixture.

Training: per language at most ``SAMPLE_BUCKETS`` labelled texts (of each
hash bucket the text with the least hash), used whole; tasks count their
n-grams, Spark sums the counts. The model is one table of ``FEATURES`` counts
per language, so its size does not depend on the corpus.

Inference is done text by text where the texts lie. Defined cases: a null
text or one without a letter is ``und`` with score 0 and an empty mixture, as
is every text if nothing was learned; equal proportions go to the first
language by name; null ids are kept; repeated rows are judged each; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SAMPLE_BUCKETS = 1500
FEATURES = 1 << 16
LONGEST = 3  # n-gram lengths 1 to 3, the longest weighs in the likelihood
SMOOTHING = 0.5
EM_STEPS = 25
EM_TOLERANCE = 1e-4
#: Weight of the BIC penalty: overlapping n-grams are not independent draws.
PENALTY = 3.0


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def letter_table() -> np.ndarray:
    """For each code point below 0x3000, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x3000)), bool, 0x3000)


def features(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the lower-cased text and their counts; every run of
    other characters is one separator."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(letters[np.minimum(points, len(letters) - 1)] | (points >= len(letters)), points, 32)
    points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])].astype(np.uint64)
    if len(points) < LONGEST:
        return np.zeros(0, np.int64), np.zeros(0)
    code = points[: len(points) - LONGEST + 1].copy()
    for k in range(1, LONGEST):
        code = code * np.uint64(1 << 21) + points[k : len(points) - LONGEST + 1 + k]
    code *= np.uint64(0x9E3779B97F4A7C15)
    hashed = (code >> np.uint64(40)).astype(np.int64) % FEATURES
    if len(hashed) > FEATURES // 4:
        counts = np.bincount(hashed, minlength=FEATURES)
        found = np.flatnonzero(counts)
        return found, counts[found].astype(float)
    found, counts = np.unique(hashed, return_counts=True)
    return found, counts.astype(float)


def mixture(counts: np.ndarray, likelihood: np.ndarray) -> tuple[np.ndarray, float]:
    """EM: proportions of the languages (columns) and the log-likelihood."""
    k = likelihood.shape[1]
    share = np.full(k, 1.0 / k)
    total, last = counts.sum(), -np.inf
    for _ in range(EM_STEPS if k > 1 else 1):
        joint = likelihood * share
        mass = joint.sum(axis=1)
        value = float(counts @ np.log(mass))
        if value - last < EM_TOLERANCE * total:
            break
        last = value
        share = (counts / mass) @ joint / total
    return share, value


def infer(text: str | None, log_model: np.ndarray, letters: np.ndarray) -> dict[int, float]:
    """Language number -> proportion, for the best language set by BIC."""
    if not len(log_model) or not has_letter(text):
        return {}
    found, counts = features(text, letters)
    if not len(found):
        return {}
    logs = log_model[:, found].T
    likelihood = np.exp(logs - logs.max(axis=1, keepdims=True))  # a constant per n-gram changes no proportion
    share, _ = mixture(counts, likelihood)
    order = np.argsort(-share, kind="stable")
    best_single = int(np.argmax(counts @ logs))
    chosen, best = [best_single], float(counts @ np.log(likelihood[:, best_single]))
    answer = {best_single: 1.0}
    for size in range(2, len(order) + 1):
        tried = list(order[:size])
        if best_single not in tried:
            tried[-1] = best_single
        part, value = mixture(counts, likelihood[:, tried])
        value -= PENALTY * 0.5 * (size - 1) * np.log(counts.sum())
        if value <= best:
            break
        chosen, best, answer = tried, value, dict(zip(map(int, tried), map(float, part)))
    return answer


def _count_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    letters, sums = letter_table(), {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            found, counts = features(text, letters)
            sums.setdefault(lang, np.zeros(FEATURES))[found] += counts
    for lang, counts in sums.items():
        found = np.flatnonzero(counts)
        if len(found):
            yield pd.DataFrame({"lang": lang, "feature": found, "n": counts[found]})


def fit(labelled: DataFrame, buckets: int = SAMPLE_BUCKETS) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and log-likelihoods [language, feature], from
    (text, lang) rows; rows with a null text or language teach nothing."""
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang", F.xxhash64("text").alias("h"))
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    least = rows.groupBy("lang", "bucket").agg(F.min("h").alias("h"))
    sample = rows.join(least, ["lang", "bucket", "h"], "left_semi").dropDuplicates(["lang", "bucket", "h"])
    counts = sample.select("lang", "text").mapInPandas(_count_rows, "lang string, feature int, n double")
    sums = counts.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow().to_pandas()  # FEATURES rows a language at most
    langs = sorted(sums["lang"].unique())
    model = np.full((len(langs), FEATURES), SMOOTHING)
    model[sums["lang"].map({c: i for i, c in enumerate(langs)}).to_numpy(int), sums["feature"].to_numpy(int)] += sums["n"].to_numpy()
    return langs, np.log(model / model.sum(axis=1, keepdims=True)) if langs else model


def language_mixture(text: Column, spark: SparkSession, langs: list[str], log_model: np.ndarray) -> Column:
    """Struct (lang_pred, score, mixture) of a text column."""
    shared = spark.sparkContext.broadcast(log_model.astype(np.float32))

    @F.pandas_udf("lang_pred string, score double, mixture map<string,double>")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters, model = letter_table(), shared.value
        for texts in batches:
            out = []
            for text in texts:
                found = infer(text, model, letters)
                top = min(found, key=lambda i: (-found[i], i), default=None)
                named = {langs[i]: p for i, p in found.items()}
                out.append(("und", 0.0, named) if top is None else (langs[top], min(1.0, found[top]), named))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "mixture"])

    return predicted(text)


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    langs, model = fit(docs.filter(~held_out).select("text", "lang"))
    found = language_mixture(F.col("text"), spark, langs, model)
    return docs.select("doc_id", held_out.alias("held_out"), found.alias("f")).select("doc_id", "held_out", "f.*")
