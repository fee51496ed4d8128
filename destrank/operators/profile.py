"""Column profiles from sketches that can be merged.

One pass over a table sums every column up to a row of fixed size: how many
values are missing (NULL, or NaN in floating columns), a sketch of the distinct
values, one of the most frequent values and one of the lengths. The rows of
several tables, days or files with the same columns merge into the profile of
them all without reading any of them again.

Row and missing counts are exact, and so are the least and the greatest length.
Distinct counts are within about ``DISTINCT_ERROR`` (two standard errors), and
exact up to a few hundred. Every value that makes up more than 4 in
``TRACKED`` of a column is among its frequent ones; all counts are exact for
columns of fewer than ``TRACKED`` * 3 / 4 values. Quantiles of lengths are
within 1.5 % of the rank asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HLL_BITS = 12
DISTINCT_ERROR = 0.035
TRACKED = 4096
QUANTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
#: Longer values are told by their beginning and a checksum in the list of frequent ones.
SHOWN_CHARS = 64


def _missing(c: Column, kind: T.DataType) -> Column:
    return c.isNull() | F.isnan(c) if isinstance(kind, (T.DoubleType, T.FloatType)) else c.isNull()


def _told(c: Column, kind: T.DataType) -> Column:
    """A value as text; nested ones as JSON, binary ones as hexadecimal digits."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return F.hex(c) if isinstance(kind, T.BinaryType) else c.cast("string")


def column_sketches(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row a column, in one pass: column_name, n_rows, n_missing and sketches."""
    fields = [f for f in df.schema if columns is None or f.name in columns]
    if not fields:
        raise ValueError("no column to profile")
    prepared, sums = [], []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        value = F.when(~_missing(c, f.dataType), _told(c, f.dataType))
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        known = ~_missing(c, f.dataType)
        shown = value
        if nested or isinstance(f.dataType, (T.StringType, T.BinaryType)):
            mark = F.concat(F.left(value, F.lit(SHOWN_CHARS // 2)), F.lit("... "), F.hex(F.xxhash64(value)))
            shown = F.when(F.length(value) <= SHOWN_CHARS, value).otherwise(mark)
        size = F.octet_length(c) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else None
        prepared += [shown.alias(f"v{i}"), F.xxhash64(value if nested else c).alias(f"h{i}"), known.alias(f"known{i}")]
        if size is not None:
            prepared.append(size.cast("long").alias(f"n{i}"))
        sums.append(
            F.struct(
                F.lit(i).alias("place"), F.lit(f.name).alias("column_name"), F.count(F.lit(1)).alias("n_rows"),
                F.count_if(~F.col(f"known{i}")).alias("n_missing"),
                F.expr(f"hll_sketch_agg(h{i}, {HLL_BITS}) FILTER (WHERE known{i})").alias("distinct_sketch"),
                F.expr(f"approx_top_k_accumulate(v{i}, {TRACKED}) FILTER (WHERE known{i})").alias("top_sketch"),
                F.kll_sketch_agg_bigint(F.lit(None).cast("long") if size is None else f"n{i}").alias("length_sketch"),
            )
        )
    return df.select(*prepared).agg(F.array(*sums).alias("rows")).select(F.inline("rows"))


def merged(parts: Sequence[DataFrame]) -> DataFrame:
    """The sketches of all ``parts`` together, column by column."""
    return reduce(DataFrame.unionByName, parts).groupBy("column_name").agg(
        F.min("place").alias("place"), F.sum("n_rows").alias("n_rows"), F.sum("n_missing").alias("n_missing"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.expr(f"approx_top_k_combine(top_sketch, {TRACKED})").alias("top_sketch"),
        F.kll_merge_agg_bigint("length_sketch").alias("length_sketch"),
    )


def profile(sketches: DataFrame, top: int = 10) -> DataFrame:
    """What the sketches tell: n_distinct, the ``top`` most frequent values
    with their counts (equal counts by value), quantiles of lengths in bytes."""
    found = F.expr(f"approx_top_k_estimate(top_sketch, {TRACKED * 3 // 4})")
    by_count = F.transform(found, lambda r: F.struct((-r["count"]).alias("less"), r["item"].alias("value")))
    best = F.transform(
        F.slice(F.array_sort(by_count), 1, top), lambda r: F.struct(r["value"].alias("value"), (-r["less"]).alias("n"))
    )
    points = F.array(*[F.lit(q) for q in QUANTILES])
    lengths = F.when(
        F.kll_sketch_get_n_bigint("length_sketch") > 0, F.kll_sketch_get_quantile_bigint("length_sketch", points)
    )
    return sketches.select(
        "place", "column_name", "n_rows", "n_missing", F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"),
        best.alias("top_values"), lengths.alias("lengths"),
    )
