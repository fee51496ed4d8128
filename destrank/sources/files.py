"""File sources and sinks (CSV, JSON lines, salvaged JSON feeds).

Paths may be any Hadoop URI (``s3a://``, ``hdfs://``, ``file:``), so a
bucket object is read and written in place rather than copied to a
machine-local folder first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from destrank.functions.jsonx import salvage_objects
from destrank.sources.blocks import BalancedObjects, QuotedLines, records

# Text fields may hold line breaks, quotes and blanks: quote them, double the
# quote inside fields, read records that span lines, trim nothing.
# NULL is written as \\N, so that an empty text stays an empty text.
CSV_OPTIONS = {
    "header": "true", "multiLine": "true", "quote": '"', "escape": '"', "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, empty_is_null: bool = False) -> DataFrame:
    """A CSV table with a header, columns taken by name and cast to ``schema``
    (text that does not parse becomes NULL). Other columns are ignored; a
    missing one raises. ``empty_is_null`` is for files of other writers, which
    leave NULL empty. Each file is read by one task; see ``read_csv_blocks``."""
    return _by_name(spark.read.options(**CSV_OPTIONS).csv(path), path, schema, empty_is_null)


def read_csv_blocks(spark: SparkSession, path: str, schema: T.StructType | str, empty_is_null: bool = False) -> DataFrame:
    """The rows of ``read_csv``, each file read by many tasks although its
    fields may hold line breaks: the state at every cut is worked out first.
    All files must have the same header. Line breaks inside fields stay as they
    are (``read_csv`` makes them \\n where a file's lines end with \\r\\n)."""
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    places = ", ".join(f"c{i} string" for i in range(len(header)))
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "multiLine")}
    found = records(spark, path, QuotedLines(quote=CSV_OPTIONS["quote"])).where(~F.col("first") & (F.col("text") != ""))
    row = found.select(F.from_csv("text", places, options).alias("row"))
    return _by_name(row.select(*[row.row[f"c{i}"].alias(c) for i, c in enumerate(header)]), path, schema, empty_is_null)


def _by_name(raw: DataFrame, path: str, schema: T.StructType | str, empty_is_null: bool) -> DataFrame:
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    missing = [f.name for f in schema if f.name.lower() not in {c.lower() for c in raw.columns}]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")

    def column(f: T.StructField) -> Column:
        text = F.nullif(F.col(f"`{f.name}`"), F.lit("")) if empty_is_null else F.col(f"`{f.name}`")
        return (text if f.dataType == T.StringType() else F.trim(text).try_cast(f.dataType)).alias(f.name)

    return raw.select(*[column(f) for f in schema])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line; NULL fields are omitted as usual."""
    df.write.mode(mode).json(path)


def salvage_lines(lines: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """Objects found in a text column, parsed with ``schema``.

    Adds ``_valid``: False for candidates that are not valid JSON (kept so
    callers can count them; the salvage itself drops them).
    """
    return _parsed(lines.select(F.explode(salvage_objects(text)).alias("_obj")), schema)


def _parsed(found: DataFrame, schema: T.StructType | str) -> DataFrame:
    # A probe without the caller's fields tells malformed text apart: repeated
    # keys, NaN and values of other types are no reason to drop a record.
    probe = F.from_json("_obj", "_none string, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    return found.select(
        F.from_json("_obj", schema).alias("_rec"),
        probe["_bad"].isNull().alias("_valid"),
    ).select("_rec.*", "_valid")


def feed_objects(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Every JSON object of a feed of concatenated arrays, balanced braces and
    strings taken into account, with ``_valid``: False for what is no JSON (an
    object broken off, also by the end of the file), so callers can count it."""
    return _parsed(records(spark, path, BalancedObjects()).select(F.col("text").alias("_obj")), schema)


def read_feed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The valid objects of ``feed_objects``. Unlike the salvage by pattern
    (``read_salvaged_feed``) it keeps objects with braces in their texts or
    with objects inside, and it reads one file by many tasks too."""
    return feed_objects(spark, path, schema).where("_valid").drop("_valid")


def read_salvaged_feed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a feed of several concatenated JSON arrays and keep the objects.

    The file is split at each opening brace, so it is read by many tasks and an
    object may span lines. A candidate runs from the brace to the first closing
    brace; a piece without one (an outer object, or one cut off at the end of
    the file) is none. Candidates that are not JSON are dropped; count them
    with ``salvage_lines``.
    """
    pieces = spark.read.option("lineSep", "{").text(path)
    inner = F.regexp_extract("value", r"(?s)^([^}]*\})", 1)
    found = pieces.where(F.contains("value", F.lit("}"))).select(F.concat(F.lit("{"), inner).alias("_obj"))
    return _parsed(found, schema).where("_valid").drop("_valid")
