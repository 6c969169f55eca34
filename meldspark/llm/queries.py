"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from meldspark.llm import oracles
from meldspark.llm.op01_bpe import bpe_digests
from meldspark.llm.op02_token_files import token_files
from meldspark.llm.op03_quality_classifier import quality_scores
from meldspark.llm.op04_quality import quality_rules
from meldspark.llm.op05_simhash import near_duplicate_rows
from meldspark.llm.op06_pii import pii_spans
from meldspark.llm.op07_html import extract_text
from meldspark.llm.op08_decontamination import contaminated_documents
from meldspark.llm.op09_sharding import shards
from meldspark.llm.op10_token_counts import token_counts
from meldspark.llm.op11_chunk_bpe import byte_bpe_digests
from meldspark.llm.op12_prefix_trie import conversation_trie
from meldspark.llm.op13_periodic_runs import run_digests, with_planted_runs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_bpe": lambda spark, sf_dir: bpe_digests(documents(spark, sf_dir)),
    "op2_token_files": lambda spark, sf_dir: token_files(documents(spark, sf_dir)),
    "op3_quality_classifier": lambda spark, sf_dir: quality_scores(
        documents(spark, sf_dir), table(spark, sf_dir, "labels")
    ),
    "op4_quality_rules": lambda spark, sf_dir: quality_rules(documents(spark, sf_dir)),
    "op5_simhash": lambda spark, sf_dir: near_duplicate_rows(documents(spark, sf_dir)),
    "op6_pii": lambda spark, sf_dir: pii_spans(documents(spark, sf_dir)),
    "op7_html": lambda spark, sf_dir: extract_text(table(spark, sf_dir, "pages")),
    "op8_decontamination": lambda spark, sf_dir: contaminated_documents(
        documents(spark, sf_dir), table(spark, sf_dir, "benchmark")
    ),
    "op9_sharding": lambda spark, sf_dir: shards(documents(spark, sf_dir)),
    "op10_token_counts": lambda spark, sf_dir: token_counts(documents(spark, sf_dir)),
    "op11_chunk_bpe": lambda spark, sf_dir: byte_bpe_digests(documents(spark, sf_dir)),
    "op12_prefix_trie": lambda spark, sf_dir: conversation_trie(table(spark, sf_dir, "conversations")),
    "op13_periodic_runs": lambda spark, sf_dir: run_digests(with_planted_runs(documents(spark, sf_dir))),
}

ORACLES: dict[str, str] = {
    "op4_quality_rules": oracles.quality_sql(),
    "op8_decontamination": oracles.DECONTAMINATION,
    "op12_prefix_trie": oracles.CONVERSATION_TRIE,
}
