"""Corpus pipeline over ``documents``: toxic documents go, then copies, near duplicates and contaminated ones; the rest is encoded.

STAGES lists (name, function) in order; each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from studytrail.llm import bpe_codec, decontamination, exact_dedup, near_dups, tables, toxicity
from studytrail.llm.queries import VOCABULARY
from studytrail.session import bounded_batches


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; labels are learnt from the folds that op6 learns from."""
    bounded_batches(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, tables.table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id."""
    return near_dups.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    bounded_batches(spark)
    return decontamination.clean_rows(docs, tables.table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document that is left."""
    bounded_batches(spark)
    return bpe_codec.digests(docs, VOCABULARY)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("jaccard_join", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("bpe_codec", bpe_stage),
]
#: SQL can express neither the learnt scores nor the BPE; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tables.stored(stage(spark, docs, sf_dir), name)
    return docs
