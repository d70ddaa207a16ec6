"""Corpus pipeline: language filter, near-duplicate removal, PII masking, source mixing, encoding.

Each stage is ``(name, function(spark, docs, sf_dir) -> DataFrame)``; its
result is written as Parquet and read again as the next stage's ``docs``.
Models are fitted on the stage's own input. All stages but the last return
the columns of ``documents`` (and any others that came with them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firelog.llm import jaccard, langid, mixing, pii, sentencepiece
from firelog.llm.common import read_table, stored

# Texts whose best cosine is lower are taken as no language at all, if they are long enough to tell.
MIN_LANGUAGE_SCORE = 0.1


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language (operator 2)."""
    return langid.keep_known(docs, langid.train(docs), MIN_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id (operator 9)."""
    return jaccard.one_of_each(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked by kind (operator 4)."""
    return pii.mask(docs, pii.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, gathered by output shard (operator 5)."""
    return mixing.mixed_rows(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text (operator 1)."""
    return sentencepiece.encode(docs)


STAGES = [
    ("language_id", language_filter),
    ("near_duplicates", near_duplicates),
    ("pii", mask_pii),
    ("mixing", mix_sources),
    ("sentencepiece", encode_texts),
]

# The stages learn models and draw by hashes that SQL does not have; a test compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
