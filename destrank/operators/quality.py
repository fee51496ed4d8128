"""Data-quality operators: null audit and row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def null_audit(df: DataFrame, columns: Sequence[str] | None = None, table: str | None = None) -> DataFrame:
    """One row per column with its NULL count (one pass over the data).

    NaN in floating columns counts as missing too, as pandas would.
    """
    cols = list(columns) if columns is not None else df.columns
    types = dict(df.dtypes)

    def missing(c: str):
        cond = F.col(c).isNull()
        if types[c] in ("double", "float"):
            cond = cond | F.isnan(F.col(c))
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")

    counts = df.agg(*[missing(c).alias(f"_{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("null_count")) for i, c in enumerate(cols)])
    out = counts.select(F.inline(rows))
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), "*")
    return out


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills in when ``df`` is written or
    collected: the count costs no extra pass."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)`` for several tables in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
