"""Quality classifier: an interpolated modified Kneser-Ney model over
characters, one per language, trained on trusted text.

1. Tasks count the n-grams of all texts, and apart from that those of trusted
   texts, per language (numpy); Spark sums the counts, sharded by n-gram.
2. Continuation counts of the lower orders, sums per history and discounts are
   grouped from these counts; joins by n-gram, by history and by suffix then
   give every n-gram of the corpus its interpolated probability, from order 1
   up. An unseen history falls through to the next lower order.
3. The log-probabilities are summed per document. The table is cut into shards
   of at most ``SHARD_ROWS`` rows by n-gram hash; each is broadcast and adds
   its part to every document's sum (one pass a shard, so memory is bounded).
4. A document is rejected if its mean negative log-probability exceeds the
   ``QUANTILE`` of trusted documents of its language, with ``MARGIN`` added
   for the spread of short texts.

Characters are lower-cased, digits are one symbol, runs of white space
another; code points from 0x800 on are folded into 0x7FF symbols.

Defined cases: a null text has no symbols, a null perplexity and is kept, as
are languages without trusted text (they have no model); an empty text is
scored by its end symbol alone; a null language is a language of its own;
label rows that repeat or contradict count as trusted if any of them is;
other columns are passed on; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_name, saved, table

ORDER = 5
SYMBOL_BITS = 12
START, SPACE, END, DIGIT = 0, 1, 2, 3
FOLD_FROM = 0x800
SHARD_ROWS = 4_000_000
#: Trusted ids of at most so many rows are broadcast (8 bytes each).
TRUSTED_ROWS = 4_000_000
QUANTILE = 0.99
#: Nats added to the quantile: MARGIN * (1 + sqrt(SHORT / symbols)).
MARGIN, SHORT = 0.15, 600.0
TEXTS_AT_ONCE = 500
GRAMS_HELD = 2_000_000


def symbols(text: str) -> np.ndarray:
    """The symbols of a text, with start symbols before and the end symbol behind."""
    points = np.frombuffer(" ".join(text.lower().split()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    points = np.where(points >= FOLD_FROM, FOLD_FROM + points % (FOLD_FROM - 1), points)
    points[points == 32] = SPACE
    points[(points >= 48) & (points <= 57)] = DIGIT
    return np.concatenate([np.full(ORDER - 1, START), points, [END]])


def grams(text: str) -> np.ndarray:
    """One code per symbol: the symbol with the ORDER - 1 before it."""
    s = symbols(text)
    n = len(s) - ORDER + 1
    code = s[:n]
    for k in range(1, ORDER):
        code = (code << SYMBOL_BITS) | s[k : k + n]
    return code


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, pd.DataFrame]]:
    """Rows with a text, a few hundred of one language at a time."""
    for batch in batches:
        batch = batch[batch["text"].notna()]
        for lang, part in batch.groupby("lang", sort=False):
            for at in range(0, len(part), TEXTS_AT_ONCE):
                yield lang, part.iloc[at : at + TEXTS_AT_ONCE]


def _count_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, list[pd.Series]] = {}

    def emptied(lang: str) -> pd.DataFrame:
        sums = pd.concat(held.pop(lang))
        sums = sums.groupby(level=0).sum()
        return pd.DataFrame({"lang": lang, "g": sums.index, "c": sums.to_numpy()})

    for lang, part in _runs(batches):
        codes = [grams(t) for t in part["text"]]
        trusted = np.repeat(part["trusted"].to_numpy(bool), [len(c) for c in codes])
        at, found = pd.factorize(np.concatenate(codes))
        counts = np.bincount(at, weights=trusted, minlength=len(found)).astype(np.int64)
        held.setdefault(lang, []).append(pd.Series(counts, index=found))
        if sum(map(len, held[lang])) > GRAMS_HELD:
            merged = pd.concat(held[lang])
            held[lang] = [merged.groupby(level=0).sum()]
            if len(held[lang][0]) > GRAMS_HELD // 2:
                yield emptied(lang)
    for lang in list(held):
        yield emptied(lang)


def _low(code: Column, order: int) -> Column:
    return code.bitwiseAND(F.lit((1 << (SYMBOL_BITS * order)) - 1))


def _discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): the modified Kneser-Ney discounts of one order."""
    n = [F.sum((F.col("c") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.5))

    def d(k: int) -> Column:
        raw = k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
        return F.greatest(F.lit(0.1), F.least(F.lit(k - 0.1), F.coalesce(raw, F.lit(k * 0.5)))).alias(f"d{k}")

    return counts.groupBy("lang").agg(*n).select("lang", d(1), d(2), d(3))


def _discount(c: Column) -> Column:
    return F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))


def corpus_log_probabilities(totals: DataFrame) -> DataFrame:
    """(lang, g, logp) of every n-gram of ``totals`` (lang, g, c), c being its
    trusted count, for the languages that have trusted text."""
    seen = {ORDER: totals.filter("c > 0")}
    for n in range(ORDER - 1, 0, -1):  # continuation counts: distinct symbols before
        seen[n] = saved(seen[n + 1].groupBy("lang", _low(F.col("g"), n).alias("g")).agg(F.count(F.lit(1)).alias("c")), "seen")
    wanted = {ORDER: totals.select("lang", "g")}
    for n in range(ORDER - 1, 0, -1):
        wanted[n] = saved(wanted[n + 1].select("lang", _low(F.col("g"), n).alias("g")).distinct(), "wanted")
    lower = None
    for n in range(1, ORDER + 1):
        history = F.shiftright("g", SYMBOL_BITS)
        counted = seen[n].join(_discounts(seen[n]), "lang")
        c = F.col("c")
        sums = counted.groupBy("lang", history.alias("h")).agg(
            F.sum("c").alias("total"), F.sum(_discount(c)).alias("held"), F.count(F.lit(1)).alias("types"),
            *[F.first(f"d{k}").alias(f"d{k}") for k in (1, 2, 3)],
        )
        rows = wanted[n].join(seen[n], ["lang", "g"], "left").withColumn("h", history)
        rows = rows.join(sums, ["lang", "h"], "inner" if n == 1 else "left")
        own = F.coalesce(F.greatest(c - _discount(c), F.lit(0.0)), F.lit(0.0)) / F.col("total")
        if n == 1:
            below = F.lit(1.0) / (F.col("types") + 1)
        else:
            rows = rows.withColumn("s", _low(F.col("g"), n - 1)).join(lower.select("lang", F.col("g").alias("s"), F.col("p").alias("below")), ["lang", "s"])
            below = F.col("below")
        lower = saved(rows.select("lang", "g", F.coalesce(own + F.col("held") / F.col("total") * below, below).alias("p")), "order")
    return lower.select("lang", "g", F.log("p").alias("logp"))


def _sorted_arrays(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams, ascending, and their log-probabilities."""
    got = rows.select("g", F.col("logp").cast("float")).toArrow()
    keys, values = got["g"].to_numpy(), got["logp"].to_numpy()
    order = np.argsort(keys)
    return keys[order], values[order]


def _score(shared) -> "F.UserDefinedFunction":
    """By (text, lang): the sum of -logp over the n-grams that the shard has,
    and the number of n-grams."""

    @F.pandas_udf("nll double, n long")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        shard = shared.value
        for text, lang in batches:
            out, sizes = np.zeros(len(text)), np.zeros(len(text), np.int64)
            rows = pd.DataFrame({"text": text.array, "lang": lang.array})
            for name, part in _runs(iter([rows])):
                if name not in shard:
                    continue
                keys, values = shard[name]
                if not len(keys):
                    keys, values = np.zeros(1, np.int64), np.zeros(1, np.float32)
                codes = [grams(t) for t in part["text"]]
                sizes[part.index] = list(map(len, codes))
                at, found = pd.factorize(np.concatenate(codes))
                place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                logp = np.where(keys[place] == found, values[place], 0.0)
                starts = np.concatenate([[0], np.cumsum([len(c) for c in codes])[:-1]])
                out[part.index] = -np.add.reduceat(logp[at], starts)
            yield pd.DataFrame({"nll": out, "n": sizes})

    return score


def with_trust(docs: DataFrame, labels: DataFrame, out: str, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with a boolean column: labelled of good quality and not toxic."""
    good = labels.filter((F.col("quality") == 1) & ~F.coalesce(F.col("toxic") == 1, F.lit(False)))
    good = good.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias(f"{out}_id")).distinct()
    few = good.count() <= TRUSTED_ROWS
    joined = docs.join(F.broadcast(good) if few else good, docs[id_col] == F.col(f"{out}_id"), "left")
    return joined.withColumn(out, F.col(f"{out}_id").isNotNull()).drop(f"{out}_id")


def with_perplexity(docs: DataFrame, trusted: str, out: str, text: str = "text", lang: str = "lang", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``docs`` with column ``out``: struct (nll, symbols), nll the mean
    negative log-probability of a symbol, null without a model or text."""
    spark = docs.sparkSession
    language = F.coalesce(F.concat(F.lit("="), F.col(lang)), F.lit(""))  # a null language is one of its own
    source = docs.select(F.col(text).cast("string").alias("text"), language.alias("lang"), F.col(trusted).alias("trusted"))
    totals = source.mapInPandas(_count_rows, "lang string, g long, c long").groupBy("lang", "g").agg(F.sum("c").alias("c"))
    model = corpus_log_probabilities(saved(totals, "grams"))
    shards = max(1, -(-model.count() // shard_rows))
    langs = [r["lang"] for r in model.select("lang").distinct().collect()]
    got = docs.withColumn(out, F.struct(F.lit(0.0).alias("nll"), F.lit(0).cast("long").alias("n")))
    for k in range(shards):
        rows = model.filter(F.pmod(F.xxhash64("g"), F.lit(shards)) == k)
        shard = {name: _sorted_arrays(rows.filter(F.col("lang") == name)) for name in langs}
        step = fresh_name(got, f"{out}_part")
        got = got.withColumn(step, _score(spark.sparkContext.broadcast(shard))(F.col(text).cast("string"), language))
        total = F.struct((F.col(out)["nll"] + F.col(step)["nll"]).alias("nll"), F.greatest(F.col(out)["n"], F.col(step)["n"]).alias("n"))
        got = got.withColumn(out, total).drop(step)
        if k + 1 < shards:
            got = saved(got, "partial")
    n = F.col(out)["n"]
    mean = F.struct((F.col(out)["nll"] / n).alias("nll"), n.alias("symbols"))
    return got.withColumn(out, F.when(n > 0, mean))


def thresholds(scored: DataFrame, trusted: Column, score: Column, lang: str = "lang", quantile: float = QUANTILE) -> DataFrame:
    """(lang, threshold): the quantile of trusted documents' excess over the margin."""
    rows = scored.filter(trusted & score.isNotNull())
    return rows.groupBy(F.col(lang).alias("_lang")).agg(F.percentile_approx(score["nll"] - margin(score), quantile, 100_000).alias("_threshold"))


def margin(score: Column) -> Column:
    return MARGIN * (1 + F.sqrt(F.lit(SHORT) / score["symbols"]))


def rejected(score: Column, threshold: Column) -> Column:
    return F.coalesce(score["nll"] - 2 * margin(score) > threshold, F.lit(False))


def quality_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text the model finds too unlike trusted text."""
    columns = docs.columns
    trust = fresh_name(docs, "_trusted")
    score = fresh_name(docs, "_score")
    scored = with_perplexity(with_trust(docs, labels, trust), trust, score)
    limits = saved(thresholds(scored, F.col(trust), F.col(score)), "thresholds")
    kept = scored.join(limits, scored["lang"].eqNullSafe(limits["_lang"]), "left").filter(~rejected(F.col(score), F.col("_threshold")))
    return kept.select(*columns)


def op4_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels")
    scored = with_perplexity(with_trust(docs, labels, "trusted"), "trusted", "score")
    scored = saved(scored.select("doc_id", "lang", "trusted", "score"), "scores")
    limits = thresholds(scored, F.col("trusted"), F.col("score"))
    found = scored.join(F.broadcast(limits) if limits.count() <= 10_000 else limits, scored["lang"].eqNullSafe(F.col("_lang")), "left")
    return found.select(
        "doc_id", "lang", F.col("score.symbols").alias("n_symbols"), F.exp("score.nll").alias("perplexity"),
        (~rejected(F.col("score"), F.col("_threshold"))).alias("kept"),
    )
