"""A corpus pipeline: quality, exact and near duplicates, benchmark leaks, tokens.

Each stage works on all rows its predecessor kept, and is written before the
next one reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import byte_bpe, decontaminate, exact_dedup, near_dedup, quality
from corvane.llm.queries import quality_model, rank_file
from corvane.llm.tables import table, written
from corvane.session import prepare

ORACLE_SQL = None  # learnt scores, MinHash and token ids are beyond SQL; the tests use brute force


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the preference model accepts."""
    return quality.keep_good(docs, quality_model(prepare(spark), sf_dir, docs))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per text."""
    prepare(spark)
    return exact_dedup.keep_one(docs)


def unlike_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group of near-duplicates, by five-word shingles and a similarity of 0.8."""
    prepare(spark)
    return near_dedup.keep_one(docs)


def unleaked_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, table(prepare(spark), sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text again."""
    prepare(spark)
    return byte_bpe.tokenised(docs, *rank_file())


STAGES = [
    ("quality classifier", good_texts),
    ("exact dedup", distinct_texts),
    ("MinHash near-dedup", unlike_texts),
    ("benchmark decontamination", unleaked_texts),
    ("byte-level BPE", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
