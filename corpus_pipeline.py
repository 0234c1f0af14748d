"""The corpus pipeline: rejects poor documents, drops copies and leaks, and packs what is left into sequences.

Each stage takes ``(spark, docs, sf_dir)`` and gives the documents that stay, with the columns of ``documents``; the
last gives the packed pieces. Between stages the documents are written and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from storelens.llm import decontamination, exact_dedup, packing, quality, simhash
from storelens.llm.common import table
from storelens.session import staged


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of the best grade is at least one half; the ratings are those of ``labels``."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays."""
    return simhash.drop_near_duplicates(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item within its error budget."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 2048 tokens."""
    return packing.packed_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good),
    ("exact dedup", exact),
    ("near dedup", near),
    ("decontamination", clean),
    ("packing", sequences),
]

# Regression, fingerprints and tokens are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
