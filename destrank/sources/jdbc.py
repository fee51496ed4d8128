"""JDBC source and sink for the warehouse tables.

A plain ``spark.read.jdbc(url, table)`` reads through one connection in
one task. Given a numeric column and its bounds the read is split into
``num_partitions`` range queries instead, each run by its own task. Bounds of
any key, text too, are found from a table of keys (``key_cuts``) and made into
one predicate a task (``range_predicates``).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_read_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned reads need lower_bound, upper_bound and num_partitions")
        if query is not None:
            raise ValueError("partitioned reads need a table (or a subquery alias) not a query")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def read_jdbc(spark: SparkSession, url: str, **kw) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(url, **kw)).load()


def modulo_predicates(int_expression: str, num_partitions: int) -> list[str]:
    """Disjoint WHERE clauses covering every row, one per partition.

    For tables without a numeric key (the warehouse tables are keyed by
    place name): ``int_expression`` is any integer expression the
    database evaluates, e.g. ``abs(hashtext(city))`` on PostgreSQL. Rows
    where it is NULL go to the first partition.
    """
    if num_partitions < 1:
        raise ValueError("num_partitions must be positive")
    clauses = [f"mod({int_expression}, {num_partitions}) = {i}" for i in range(num_partitions)]
    clauses[0] = f"({clauses[0]} OR ({int_expression}) IS NULL)"
    return clauses


def _sql_value(value: object) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, str, date)):
        raise ValueError(f"no bound can be made of {value!r}")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def key_cuts(keys: DataFrame, column: str, num_partitions: int) -> list:
    """Ascending bounds between ranges of about equally many rows of ``keys``.

    ``keys`` is any table with the key column, such as the last load or a read
    of that column alone; the bounds are Spark's range bounds, from a sample,
    and only one value a range reaches the driver. Equal keys share a range, so
    there are fewer bounds when there are few keys."""
    if num_partitions < 1:
        raise ValueError("num_partitions must be positive")
    ranged = keys.select(F.col(column).alias("k")).where(F.col("k").isNotNull()).repartitionByRange(num_partitions, "k")
    least = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min("k").alias("k"))
    return sorted(r.k for r in least.collect())[1:]


def range_predicates(expression: str, cuts: Sequence) -> list[str]:
    """Disjoint WHERE clauses covering every row: one for each range between
    the ascending ``cuts``, the first also for NULL.

    ``expression`` is the key as the database evaluates it; text needs the order
    that Spark has, that of its bytes, e.g. ``city COLLATE "C"`` on PostgreSQL."""
    bounds = [_sql_value(c) for c in cuts]
    clauses = []
    for low, high in zip([None, *bounds], [*bounds, None]):
        own = [f"{expression} >= {low}"] * (low is not None) + [f"{expression} < {high}"] * (high is not None)
        clauses.append(" AND ".join(own) or "1 = 1")
    if bounds:
        clauses[0] = f"({clauses[0]} OR {expression} IS NULL)"
    return clauses


def read_jdbc_predicates(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: list[str],
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """One task per predicate (each a WHERE clause run by the database)."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def jdbc_write_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    truncate: bool = False,
    batch_size: int = 10_000,
    num_partitions: int | None = None,
) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size), **(properties or {})}
    if truncate:
        opts["truncate"] = "true"
    if num_partitions is not None:
        # Caps concurrent connections to the warehouse.
        opts["numPartitions"] = str(num_partitions)
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **kw) -> None:
    """Replace (default) or append a warehouse table.

    Overwrite drops and re-creates the table unless ``truncate=True``,
    which keeps the table definition.
    """
    df.write.format("jdbc").options(**jdbc_write_options(url, table, **kw)).mode(mode).save()
