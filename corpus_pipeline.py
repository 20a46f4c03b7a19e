"""A training-data pipeline: quality rules, near-duplicates, secrets, packing.

Each stage reads what the one before has written.  The first three return documents; the last returns the pieces of
documents with their places in sequences.  Null ids, null and empty texts, and repeated rows go through every stage; what
each makes of them is told by its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireloom.llm import markov_secrets, minmax_dedup, packing, quality_mcd
from wireloom.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality_mcd.judged(docs, COLUMNS).filter("kept").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: one with the least id, null ids last; rows without words stay."""
    return minmax_dedup.one_of_each(docs.select(COLUMNS))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by a mark."""
    clean = markov_secrets.redacted(docs.select(COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_duplicates), ("secrets", secrets), ("packing", pack)]

#: Robust estimates, clusters and token ids are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        path = scratch_path(spark, name.replace(" ", "-"))
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
