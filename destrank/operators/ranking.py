"""Exact average ranks, weighted scores and top-k at any data size.

pandas' ``Series.rank()`` gives tied values the mean of their positions
and leaves NULL unranked. A global ``rank()`` window would pull every row
into one task, so ranks are computed from a value histogram instead:

1. ``(criterion, group, value) -> count``: a partial aggregation, so a
   value held by a third of all rows becomes a single histogram row.
2. The checkpointed histogram is dealt out by ranges of (criterion, value),
   about ``rows_per_bucket`` rows to a part. Equal values always fall in the
   same part, so ties never straddle a cut; the part's number is its bucket.
   The cuts are Spark's own, from a sample: none is in the plan or in a task
   that gathers all values.
3. Bucket totals and their running sum (a table of at most
   ``criteria x groups x buckets`` rows) give each bucket its offset.
4. Inside a bucket a windowed running count gives the number of rows
   strictly before the value; the average rank is
   ``offset + before + (count + 1) / 2``. When every criterion fits in
   one bucket steps 2 and 3 are skipped.
5. Ranks are joined back on the value; histograms whose size the stats
   job proved small are broadcast, larger ones go through a shuffle join
   that adaptive execution splits if a value is hot.

Descending ranks use the same steps on a reversed order. Whole numbers,
decimals and points in time are ranked by their exact values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from destrank.fixed import DEFAULT_WEIGHTS, WEIGHT_MAX, WEIGHT_MIN
from destrank.functions.numeric import nan_to_null
from destrank.session import checkpoint_counted, ensure_checkpoint_dir

DEFAULT_ROWS_PER_BUCKET = 2_000_000
BROADCAST_MAX_ROWS = 1_000_000


@dataclass(frozen=True)
class RankSpec:
    source: str
    output: str
    ascending: bool = True


def _exact_keys(df: DataFrame, specs: Sequence[RankSpec]) -> list[Column]:
    """One rank key per spec, all of one type: bigint, decimal, microseconds,
    or double where some source is floating."""
    sources = [F.col(s.source) for s in specs]
    types = [f.dataType for f in df.select(*sources).schema]
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    if types and all(isinstance(t, T.IntegralType) for t in types):
        return [c.cast("bigint") for c in sources]
    if types and all(isinstance(t, (T.IntegralType, T.DecimalType)) for t in types):
        scale = max(t.scale for t in types if isinstance(t, T.DecimalType))
        return [c.cast(T.DecimalType(38, scale)) for c in sources]
    if types and all(isinstance(t, times) for t in types):
        return [F.unix_micros(c.cast("timestamp")) for c in sources]
    return [nan_to_null(c.cast("double")) for c in sources]


def average_ranks(
    df: DataFrame,
    specs: Sequence[RankSpec | tuple],
    partition_by: Sequence[str] = (),
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    checkpoint_input: bool = False,
) -> DataFrame:
    """Add one average-rank column per spec (pandas ``rank()`` semantics).

    ``specs`` holds ``RankSpec(source, output, ascending)`` (or tuples of
    the same). With ``partition_by`` ranks restart in every group.
    NULL and NaN values get a NULL rank and do not take a position;
    infinities are values and rank at the ends.

    Runs its jobs eagerly (checkpoints of the histogram, of its buckets if
    there are several, and of the ranked histogram); all land in the shared checkpoint
    folder, so a lost executor never forces a recompute of the ranking.
    The input is read twice (histogram, final join). With
    ``checkpoint_input`` it is first written to the checkpoint folder (its
    row count observed on the same job), so an expensive input (per-place
    means over all readings) is computed exactly once; leave it off for
    plain table scans. When that count is at most ``rows_per_bucket``,
    one bucket per criterion is proven and the histogram job is skipped.
    """
    ensure_checkpoint_dir(df.sparkSession)
    known_rows = None
    if checkpoint_input:
        df, known_rows = checkpoint_counted(df)
    specs = [s if isinstance(s, RankSpec) else RankSpec(*s) for s in specs]
    part = list(partition_by)
    values = _exact_keys(df, specs)

    # Step 1: value histogram, map-side combined.
    entries = F.array(*[F.struct(F.lit(i).alias("c"), v.alias("v")) for i, v in enumerate(values)])
    hist = (
        df.select(*part, F.explode(entries).alias("_e"))
        .select(*part, F.col("_e.c").alias("_c"), F.col("_e.v").alias("_v"))
        .where(F.col("_v").isNotNull())
        .groupBy("_c", *part, "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )

    if known_rows is not None and known_rows <= rows_per_bucket:
        # The input's observed size bounds every histogram: one bucket per
        # criterion is proven and the histogram feeds the ranking directly.
        sizes = {i: known_rows for i in range(len(specs))}
    else:
        # Written to the shared checkpoint folder; the driver receives one
        # number per criterion.
        hist = hist.checkpoint()
        counts = {r["_c"]: r["n"] for r in hist.groupBy("_c").agg(F.count(F.lit(1)).alias("n")).collect()}
        sizes = {i: counts.get(i, 0) for i in range(len(specs))}

    ascending = F.col("_c").isin([i for i, spec in enumerate(specs) if spec.ascending])
    directed = hist.withColumn("_up", F.when(ascending, F.col("_v"))).withColumn("_down", F.when(~ascending, F.col("_v")))
    order = [F.col("_up").asc(), F.col("_down").desc()]

    # Steps 2 and 3: buckets and their offsets.
    before = Window.unboundedPreceding
    if max(sizes.values(), default=0) > rows_per_bucket:
        buckets = math.ceil(sum(sizes.values()) / max(1, rows_per_bucket))
        bucketed = directed.repartitionByRange(buckets, "_c", *order).withColumn("_b", F.spark_partition_id())
        bucketed = bucketed.checkpoint()  # so that every row keeps its part
        totals = bucketed.groupBy("_c", *part, "_b").agg(F.sum("_n").alias("_t"))
        earlier = Window.partitionBy("_c", *part).orderBy("_b").rowsBetween(before, -1)
        offsets = totals.select("_c", *part, "_b", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_off"))
        if not part and buckets + len(specs) <= broadcast_max_rows:
            offsets = F.broadcast(offsets)  # a part holds several criteria only where one ends
        bucketed = bucketed.join(offsets, ["_c", *part, "_b"])
    else:
        bucketed = directed.withColumn("_b", F.lit(0)).withColumn("_off", F.lit(0).cast("long"))

    # Step 4: rank inside the bucket; about rows_per_bucket rows per task.
    in_bucket = Window.partitionBy("_c", *part, "_b").orderBy(*order).rowsBetween(before, -1)
    ranked = bucketed.select(
        "_c",
        *part,
        "_v",
        (
            F.col("_off")
            + F.coalesce(F.sum("_n").over(in_bucket), F.lit(0))
            + (F.col("_n") + F.lit(1)) / F.lit(2.0)
        ).alias("_r"),
    ).checkpoint()

    # Step 5: join back per criterion.
    out = df
    for i, spec in enumerate(specs):
        key = f"_rank_key_{i}"
        out = out.withColumn(key, values[i])
        table = ranked.where(F.col("_c") == i).select(*part, F.col("_v").alias(key), F.col("_r").alias(spec.output))
        if not part and sizes[i] <= broadcast_max_rows:
            table = F.broadcast(table)
        out = out.join(table, [*part, key], "left").drop(key)
    return out.select(*df.columns, *[s.output for s in specs])


def average_rank(df: DataFrame, source: str, output: str, ascending: bool = True, **kw) -> DataFrame:
    """Single-column form of :func:`average_ranks`."""
    return average_ranks(df, [RankSpec(source, output, ascending)], **kw)


def positions(df: DataFrame, partition_by: Sequence[str], order: str, output: str = "pos", **kw) -> DataFrame:
    """1-based position of each row inside its group, by a unique ``order``.

    Uses the bucketed rank, so a group holding most rows is still spread
    over many tasks.
    """
    ranked = average_ranks(df, [RankSpec(order, output, True)], partition_by=partition_by, **kw)
    return ranked.withColumn(output, F.col(output).cast("long"))




def _check_weights(weights: Sequence[int]) -> tuple[int, int, int]:
    if len(weights) != 3:
        raise ValueError("three weights expected: temperature, rain, humidity")
    for w in weights:
        if isinstance(w, bool) or not isinstance(w, int) or not WEIGHT_MIN <= w <= WEIGHT_MAX:
            raise ValueError(f"weight {w!r} outside {WEIGHT_MIN}..{WEIGHT_MAX}")
    return tuple(weights)  # type: ignore[return-value]


def criterion_ranks(
    means: DataFrame,
    temp: str = "avg_temp_max",
    rain: str = "avg_pop",
    humidity: str = "avg_humidity",
    checkpoint_input: bool = True,
    **kw,
) -> DataFrame:
    """The three criterion ranks: warmth ascending, rain and humidity
    descending (warmer, drier, less humid ranks higher).

    They do not depend on the weights, so an interactive caller ranks
    once and re-scores each slider change with :func:`score_from_ranks`
    (a projection). ``means`` is an aggregate (one row per place), so by
    default it is checkpointed once and the readings behind it are not
    aggregated twice.
    """
    return average_ranks(
        means,
        [
            RankSpec(temp, "rank_temp", True),
            RankSpec(rain, "rank_rain", False),
            RankSpec(humidity, "rank_humidity", False),
        ],
        checkpoint_input=checkpoint_input,
        **kw,
    )


def score_from_ranks(ranks: DataFrame, weights: Sequence[int] = DEFAULT_WEIGHTS) -> DataFrame:
    """Score = rank_temp*w_temp + rank_rain*w_rain + rank_humidity*w_hum.

    A NULL criterion makes the score NULL; such places sort last.
    """
    w_temp, w_rain, w_hum = _check_weights(weights)
    score = (
        F.col("rank_temp") * F.lit(w_temp)
        + F.col("rank_rain") * F.lit(w_rain)
        + F.col("rank_humidity") * F.lit(w_hum)
    )
    return ranks.withColumn("score", score.cast("double"))


def weighted_score(
    means: DataFrame,
    weights: Sequence[int] = DEFAULT_WEIGHTS,
    temp: str = "avg_temp_max",
    rain: str = "avg_pop",
    humidity: str = "avg_humidity",
    checkpoint_input: bool = True,
    **kw,
) -> DataFrame:
    """Criterion ranks and their weighted sum in one call."""
    _check_weights(weights)
    ranks = criterion_ranks(means, temp, rain, humidity, checkpoint_input=checkpoint_input, **kw)
    return score_from_ranks(ranks, weights)


def rank_sum(means: DataFrame, **kw) -> DataFrame:
    """Unweighted sum of the three criterion ranks."""
    return weighted_score(means, (1, 1, 1), **kw)


def top_k(df: DataFrame, k: int, by: str = "score", tie_break: Sequence[str] = ("city",)) -> DataFrame:
    """``k`` rows with the highest ``by`` (NULL last), ties by ``tie_break``.

    Planned as a TakeOrderedAndProject: every partition keeps its own top
    ``k`` and only those rows meet in the final merge.
    """
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]).limit(k)
