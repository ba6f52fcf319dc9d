"""Corpus pipeline: quality, exact copies, near copies, benchmark passages, mix.

Each stage works on what its predecessor kept, written as Parquet in the shared
folder and read again.  All stages but the last return the columns of documents;
the last adds ``repeats``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finecast.llm import decontaminate, exact_dedup, mixing, ngram_join, quality
from finecast.llm.shared import table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is fitted on the labels that are not held out."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.drop_exact(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of documents linked by five-word sets with a similarity of 0.8 or more."""
    return ngram_join.keep_first(docs, width=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, each with how often."""
    taken = mixing.mix(docs).where("repeats > 0").select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), "repeats").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
    return docs.join(taken, same).select(*[docs[c] for c in docs.columns], "repeats")


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("mixing sources to target weights", source_mix),
]

#: The classifier is fitted, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
