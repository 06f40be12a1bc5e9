"""The corpus pipeline: five stages over ``documents``, each written and read again before the next one.

Every stage works on all rows that the one before it kept, and all but the last return the columns of the documents. No
documents give no rows in any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from abasto.llm import op01_decontaminate, op05_packing, op06_secrets, op08_jaccard, op10_quality
from abasto.llm.common import stage, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit the classifier on the labelled ones of the documents and leave out what it rejects.

    A null text is scored as an empty one. Repeated rows are scored alike; without usable labels nothing is rejected.
    """
    return op10_quality.accept(docs, op10_quality.train(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents, keep the one with the smallest ``doc_id``.

    Rows without an id stay. A null text is linked with nothing. Of rows that share an id, one stays for each group they
    are the first of: by the hash of the text, then of all columns.
    """
    return op08_jaccard.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that hold a benchmark item.

    Rows without an id or a text stay. All rows of an id go where one of them holds an item.
    """
    return op01_decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark in the place of every secret. Every row stays, a null text too."""
    return op06_secrets.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences. Every row is packed on its own; a null text is its end id."""
    return op05_packing.pack(docs)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("secrets", secrets),
    ("packing", packing),
]

ORACLE_SQL = None  # the stages go beyond SQL; tests hold them against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
