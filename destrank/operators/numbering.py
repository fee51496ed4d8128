"""Row numbers over a whole table in a given order, without one task for all.

The rows are dealt out by ranges of the order and checkpointed, so that every
part keeps its rows; a row's number is its place in its part plus the rows of
all parts before. Only one count a part is summed up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from destrank.session import ensure_checkpoint_dir


def fresh(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_numbers(df: DataFrame, order: Sequence[Column | str], name: str = "rank", start: int = 1) -> DataFrame:
    """``df`` with a long column ``name`` counting from ``start`` in ``order``.

    Rows equal in all of ``order`` are numbered in any order among themselves;
    an empty table stays empty."""
    ensure_checkpoint_dir(df.sparkSession)
    part, before = fresh(df, "_part"), fresh(df, "_before")
    ranged = df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()).checkpoint()
    counts = ranged.groupBy(part).agg(F.count(F.lit(1)).alias(before))
    parts = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    offsets = counts.select(part, F.coalesce(F.sum(before).over(parts), F.lit(0)).alias(before))
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    numbered = ranged.withColumn(name, place).join(offsets, part)
    return numbered.withColumn(name, (F.col(before) + F.col(name) + F.lit(start - 1)).cast("long")).drop(part, before)
