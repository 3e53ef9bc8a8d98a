"""A corpus in five stages: each gets all that its predecessor kept, written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm.exact_dedup import drop_copies
from quarry.llm.packing import Packing, report
from quarry.llm.quality_rules import keep
from quarry.llm.secret_scan import redact
from quarry.llm.simhash_dedup import drop_near_copies
from quarry.runtime import remove, stored_at


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return keep(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    return drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return report(docs, Packing(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("secrets", secrets), ("packed", packed)]

#: No SQL: fingerprints, randomness tests and tokenizers are out of its reach; tests/llm holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, path = stored_at(stage(spark, docs, sf_dir), f"stage-{name}")
        if last:
            remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
