"""The numbered queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm import (
    bursttrie, cotraining, forest, linededup, mainhtml, mixing, nndescent, packing, prefixbpe, simhash, slicesearch, tokenfile,
    toxicity,
)
from llm.shared import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainhtml.main_texts(table(spark, sf_dir, "pages"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return forest.search(rows, rows.where("vec_id % 20 = 0"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixbpe.round_trip(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bursttrie.trie(table(spark, sf_dir, "conversations"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slicesearch.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = (
    op1_line_dedup, op2_best_fit_packing, op3_embedding_near_dedup, op4_simhash_near_dedup, op5_html_main_text,
    op6_source_mixing, op7_nearest_neighbours, op8_token_files, op9_toxicity, op10_quality_classifier,
    op11_byte_bpe, op12_conversation_trie, op13_lexical_search,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": linededup.sql(), "op12_conversation_trie": bursttrie.sql(), "op13_lexical_search": slicesearch.sql(),
    }
