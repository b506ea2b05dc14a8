"""A training-data pipeline in five stages; each one writes Parquet that the next one reads.

1. quality_rules: documents that fail the base rule or a calibrated cutoff go.
2. ngram_join: one document of each group of near duplicates stays.
3. pii: personal data, and words that give it away, are replaced in the text.
4. mix_sources: every source is repeated or thinned to its target weight.
5. packing: documents are cut into sequences along a space-filling curve.

All stages but the last return the columns they were given. Stages expect the
columns doc_id, text, lang and source; every other column travels along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import hilbert_pack, mixture, ngram_join, pii, quality_rules
from tallymart.llm.text import table
from tallymart.session import checkpoint_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.mix_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hilbert_pack.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_join", near_duplicate_stage),
    ("pii", pii_stage),
    ("mix_sources", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # tokenising and packing are beyond SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the result of each is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
