"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from destrank.session import scratch_dir

#: ASCII white space; a word is a run of anything else.
ASCII_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder and read
    back: later reads survive lost executors and repeat no work."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, plans that are run give Python tasks at most ``rows`` rows a
    batch: whole texts are large, and a batch is held by both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def kept_in_worker(name: str, made_of: tuple, make: Callable[[], object]) -> object:
    """``make()``, kept by the worker process for its next task while it is
    asked for with the same ``made_of``. Task code is shipped by value, so its
    own globals would not last."""
    store = vars(sys.modules.setdefault("_kept_by_tasks", ModuleType("_kept_by_tasks")))
    if name not in store or store[name][0] != made_of:
        store[name] = (made_of, make())
    return store[name][1]


def give_back() -> None:
    """Returns what this worker process has freed to the system. Call it where
    a task ends that held much: idle workers live on beside the next tasks."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library's, where it has one
    if trim is not None:
        trim(0)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores added until no column has it
    (column names are compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(*parts: Column) -> Column:
    """A 128-bit digest of the given strings, nulls told apart from empties."""
    return F.substring(F.sha2(F.to_json(F.struct(*[p.alias(f"c{i}") for i, p in enumerate(parts)])), 256), 1, 32)
