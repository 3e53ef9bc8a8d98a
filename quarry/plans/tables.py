"""How the supplied tables stand for a corpus: source as title, language as corpus, conversations as documents of
ordered chunks, and benchmark passages as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks (row_id, document_id, title, heading, text, ordinal, front_matter)."""
    docs = table(spark, sf_dir, "documents").where(F.col("doc_id").isNotNull())
    return docs.select(
        F.col("doc_id").alias("row_id"), F.col("doc_id").alias("document_id"), F.coalesce("source", F.lit("")).alias("title"), F.coalesce("lang", F.lit("")).alias("heading"), F.coalesce("text", F.lit("")).alias("text"),
        F.lit(0).alias("ordinal"), F.lit(False).alias("front_matter"),
    )


def turn_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents: (document_id, ordinal, chunk_id, role, text, title)."""
    rows = table(spark, sf_dir, "conversations")
    chunk = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))
    return rows.select(F.col("conv_id").alias("document_id"), F.col("turn").alias("ordinal"), chunk.alias("chunk_id"), "role", "text", F.concat(F.lit("Conversation "), F.col("conv_id").cast("string")).alias("title"))


def benchmark_terms(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """(query_id, mode, pos, term) of all planned terms of every benchmark passage; a phrase keeps its stop words."""
    from quarry.functions.text import tokens
    from quarry.operators.lexical import plan_terms

    terms = tokens(F.col("text")) if mode == "phrase" else plan_terms(F.col("text"))
    rows = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), terms.alias("terms"))
    return rows.select("query_id", F.lit(mode).alias("mode"), F.posexplode("terms").alias("pos", "term"))
