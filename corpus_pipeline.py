"""Corpus preparation: drop toxic documents, recurring lines and near duplicates, mix, pack.

Every stage works on all that the stage before it kept; its result is written as Parquet
and read again.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.linededup import dedup_lines
from llm.mixing import mixed_documents
from llm.packing import packed
from llm.shared import table, written
from llm.simhash import keep_one
from llm.toxicity import keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that recur elsewhere; none disappears, n_chars follows the text."""
    slim = dedup_lines(docs)
    return slim.select(*[_length(docs, c) if c == "n_chars" else f"`{c}`" for c in docs.columns])


def _length(docs: DataFrame, name: str) -> Column:
    changed = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col(name))
    return changed.cast(docs.schema[name].dataType).alias(name)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each document and pass."""
    return mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their place in sequences."""
    return packed(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# Fingerprints, random draws and tokens have no SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
