"""The corpus pipeline: language ID, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import common, langid, minhash, mixing, packing, radix


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognised language: null texts, texts without letters, and those
    whose predicted language has a score under ``langid.SURE``."""
    common.tuned(spark)
    return langid.accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, but for runs of white space, the smallest doc_id stays."""
    common.tuned(spark)
    return radix.without_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, of the smallest doc_id."""
    common.tuned(spark)
    return minhash.without_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A mixture of sources by temperature, under the smallest budget that drops no document.

    Documents of sources with too small a share come as repeated rows, ``mixing.MOST`` times at most.
    """
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences."""
    common.tuned(spark)
    return packing.pack_documents(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixture", mixture), ("packing", pack)]

#: Not expressible in SQL: tokenisation and the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another. What a stage stored, and its input, goes once its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, before = f"{common.shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", []
    for name, stage in STAGES:
        with common.scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        common.deleted(spark, before)
        before = [f"{folder}/{name}"]
    return docs
