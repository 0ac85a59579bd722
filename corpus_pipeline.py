"""The corpus pipeline: quality rules, exact and near duplicates, personal data, packing.

Every stage works on all that its predecessor kept. Its result is written to the shared folder
and read again, so a lost executor repeats at most one stage. All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lotwise.llm import common, exact_dedup, near_dedup, packing, pii, quality
from lotwise.llm.queries import END_ID, PII_KEY, SEQUENCE_TOKENS, VOCABULARY, packed_rows


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the likelihood ratio."""
    return quality.accepted(docs, quality.learn(docs, common.table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.deduplicate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return near_dedup.one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms; n_chars follows the text."""
    return pii.with_text_length(pii.pseudonymise(docs, PII_KEY, with_spans=False))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of the remaining documents with their places."""
    return packed_rows(packing.pack(docs, public_tokenizers.path(VOCABULARY), END_ID, SEQUENCE_TOKENS))


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# Signatures, tokenizer and keyed permutation have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
