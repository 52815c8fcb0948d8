"""From raw documents to token ids: filter, deduplicate, decontaminate, encode.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again
before the next one. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odsflow.llm import decontamination, near_duplicates, quality_crf, sentencepieces, suffix_dedup
from odsflow.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality_crf.good_only(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of 200 bytes that stand twice in what is left."""
    return suffix_dedup.without_repeats(docs)


def test_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.without_tests(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    encoded = sentencepieces.encode(docs, ["doc_id", "lang", "source"])
    return encoded.select("doc_id", "lang", "source", F.size("sp_ids").cast("long").alias("n_tokens"), "sp_ids")


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("test_passages", test_passages),
    ("token_ids", token_ids),
]

#: A learnt field, chosen paths and token ids cannot be expressed in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
