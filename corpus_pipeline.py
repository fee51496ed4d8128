"""A corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a DataFrame; ``run`` writes each result as Parquet and reads it back
as the next stage's documents. All but the last return the columns of
``documents``; the last returns the packed pieces with their token ids. No stage samples or caps
rows, and an empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from destrank.llm.common import fresh_name, saved, table
from destrank.llm.kneser_ney import quality_filter
from destrank.llm.packing import op3_vocabulary, pack
from destrank.llm.partenum_join import one_of_each_group
from destrank.llm.pii_surrogates import with_surrogates
from destrank.llm.repetition import quality_rules

#: Not expressible in SQL: learned model, keyed surrogates, tokenizer; tested against plain versions.
ORACLE_SQL = None


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the repetition limits."""
    return quality_rules(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is not too unlike trusted text of their language."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each_group(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; n_chars follows the text."""
    count = fresh_name(docs, "_entities")
    out = with_surrogates(docs, count)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        out = out.withColumn("n_chars", F.when(F.col(count) > 0, size).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids, packed into sequences;
    strings of control tokens inside documents stay text."""
    return pack(docs, op3_vocabulary(), special_as_text=True, lean=True)


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", pii),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
