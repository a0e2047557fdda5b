"""Documents to training sequences: quality rules, near-duplicates, personal data, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of ``documents``.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tickwise.llm import mixing, packing, pii, quality_rules, simhash
from tickwise.session import scratch_path


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; kept ones lose their failing lines."""
    return quality_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in training order."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", rules), ("near duplicates", near_duplicates), ("personal data", personal_data), ("source mix", source_mix), ("packing", pack)]

#: Hashes, trees and tokens have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a table in the shared folder between two stages."""
    docs, place = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{place}/{k}")
            docs = spark.read.parquet(f"{place}/{k}")
    return docs
