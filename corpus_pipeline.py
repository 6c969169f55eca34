"""The corpus pipeline: quality rules, near duplicates, decontamination, personal data, BPE ids.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is written as Parquet and read
again before the next one. All but the last return the columns of documents; the last returns one row per document
that is left: doc_id, source, lang, n_tokens, ids.

Defined cases, for all stages: an empty table stays empty; further columns pass through all but the last stage, whatever their
names; equal doc_ids and null ones are separate rows. Very long texts take memory in proportion to the longest one.
Each stage states its own rules for null and empty texts, ties and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meldspark.llm.op01_bpe import bpe_encode
from meldspark.llm.op04_quality import keep_good
from meldspark.llm.op05_simhash import one_of_each_group
from meldspark.llm.op06_pii import sanitised
from meldspark.llm.op08_decontamination import remove_contaminated
from meldspark.session import remove_staged, stage, staged_tables


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null, empty and short texts have too few words and go; repeated rows share
    their verdict; common words that tie in frequency are ranked by the word."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id. Texts without words are equal to
    each other; of repeated rows and of rows that tie with the same doc_id one stays."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item. Null and empty texts have none and stay, repeated rows share their
    verdict, items that tie on a window all count; an empty benchmark removes nothing."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and terms that reveal it replaced in their texts. Null and empty texts stay as they
    are; copies count as one text; spans that overlap or tie are replaced together, by the kind of the first."""
    return sanitised(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens, ids: the ids of every whole text. Null and empty texts have no ids; rows are
    independent, so repeated ones and ties need no rule; further columns are left out."""
    encoded = bpe_encode(docs, ("doc_id", "source", "lang"))
    return encoded.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("bpe", bpe),
]

# Fingerprints, divergences and BPE can't be written in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``. Once a stage is written, the one before and what its own work left
    in the shared folder are removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = len(staged_tables())
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
        remove_staged(spark, before, keep_last=True)
    return docs
