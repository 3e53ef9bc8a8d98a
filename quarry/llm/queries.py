"""The registered queries of this subpackage: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm import byte_bpe, chat_format, exact_dedup, packing, quality_classifier, quality_rules, secret_scan, simhash_dedup, token_files, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(_table(spark, sf_dir))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.report(_table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.report(_table(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(_table(spark, sf_dir))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.report(_table(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(_table(spark, sf_dir))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.report(_table(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(_table(spark, sf_dir), packing.Packing(public_tokenizers.path("byte_bpe_50k.json")))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(_table(spark, sf_dir))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, with the tool traffic that every assistant's turn gives rise to."""
    return chat_format.format_chats(chat_format.with_tools(_table(spark, sf_dir, "conversations")), chat_format.TOOLS)


_OPS = (
    op1_exact_dedup, op2_url_filter, op3_byte_bpe, op4_secret_scan, op5_token_files,
    op6_quality_rules, op7_quality_classifier, op8_best_fit_packing, op9_simhash_dedup, op10_chat_format,
)

_OP1_SQL = """
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents
), g AS (
  SELECT norm, count(*) AS group_size, arg_min(doc_id, row(-chars, doc_id)) AS keep_id FROM n GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM n JOIN g USING (norm)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _OPS}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": _OP1_SQL, "op2_url_filter": url_filter.SQL, "op10_chat_format": chat_format.SQL}
