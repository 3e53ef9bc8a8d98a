"""Rank fusion within and across corpora, reranking, and de-duplication of evidence."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.ranking import evidence_score
from quarry.functions.text import normalize_content_plain
from quarry.runtime import ship

RRF_K = 60  # a fixed value


def reciprocal_rank_fusion(rankings: dict[str, tuple[DataFrame, float]], limit: int | None = None) -> DataFrame:
    """``rankings``: name to (frame of query_id, document_id, rank; weight). The score is the sum of weight / (60 +
    rank); each ranking's rank stays as ``<name>_rank``."""
    names = list(rankings)
    parts = [df.select("query_id", "document_id", "rank", F.lit(name).alias("source"), F.lit(float(w)).alias("weight")) for name, (df, w) in rankings.items()]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    ranks = [F.min(F.when(F.col("source") == n, F.col("rank"))).alias(f"{n}_rank") for n in names]
    fused = every.groupBy("query_id", "document_id").agg(F.sum(F.col("weight") / (RRF_K + F.col("rank"))).alias("fusion_score"), *ranks)
    order = Window.partitionBy("query_id").orderBy(F.round("fusion_score", 12).desc(), "document_id")
    fused = fused.withColumn("position", F.row_number().over(order))
    return fused if limit is None else fused.where(F.col("position") <= limit)


def first_per_document(ranked: DataFrame) -> DataFrame:
    """A ranked list of chunks as one of documents: a document's first chunk stands for it, and ranks are dense."""
    own = Window.partitionBy("query_id", "document_id").orderBy("rank", "row_id")
    kept = ranked.withColumn("_k", F.row_number().over(own)).where("_k = 1").drop("_k")
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank", "row_id")))


def federate(per_corpus: dict[str, DataFrame], limit: int | None) -> DataFrame:
    """Lists of several corpora as one: documents with the exact title first, then 1 / (60 + rank), then the order in
    which the corpora are given, then document_id. Frames have query_id, document_id, rank, exact_title."""
    parts = [df.select("query_id", "document_id", "rank", "exact_title", F.lit(name).alias("corpus"), F.lit(i).alias("corpus_order")) for i, (name, df) in enumerate(per_corpus.items())]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    scored = every.withColumn("federation_score", 1 / (RRF_K + F.col("rank")))
    order = Window.partitionBy("query_id").orderBy(F.col("exact_title").desc(), F.col("federation_score").desc(), "corpus_order", "document_id")
    ranked = scored.withColumn("position", F.row_number().over(order))
    return ranked if limit is None else ranked.where(F.col("position") <= limit)


def rerank(rows: DataFrame, query: Column | str = "query") -> DataFrame:
    """Rows (query_id, document_id, position, base_score, title, heading, text, dual, exact_title, corpus) in the order
    of their evidence score."""
    asked = F.col(query) if isinstance(query, str) else query
    score = evidence_score(asked, F.col("base_score"), F.col("title"), F.col("heading"), F.col("text"), F.col("dual"), F.col("exact_title"))
    order = Window.partitionBy("query_id").orderBy(F.col("rerank_score").desc(), "position", "corpus", "document_id")
    return rows.withColumn("rerank_score", score).withColumn("rerank_position", F.row_number().over(order))


SIMILAR, LEAST_TOKENS = 0.92, 12  # fixed values


def deduplicate(rows: Iterable[dict], threshold: float = SIMILAR) -> tuple[list[dict], list[dict]]:
    """Greedy, in rank order: a row with the content of a kept row, or of 12 tokens or more whose set has a Jaccard
    similarity of the threshold or more with one, becomes an alternate of the first such row."""
    import re

    from quarry.functions.ranking import TOKEN

    if not 0.5 <= threshold <= 1.0:
        raise ValueError("the threshold lies between 0.5 and 1")
    kept: list[dict] = []
    sets: list[set[str]] = []
    by_content: dict[str, int] = {}
    removed = []
    for row in rows:
        words = {t.casefold() for t in re.findall(TOKEN, normalize_content_plain(row["text"] or ""))}
        at, reason = by_content.get(row["content_id"]), "content_id"
        if at is None and len(words) >= LEAST_TOKENS:
            for i, other in enumerate(sets):
                alike = len(words & other) / len(words | other)
                if alike >= threshold:
                    at, reason = i, f"token_jaccard:{alike:.4f}"
                    break
        if at is None:
            by_content[row["content_id"]] = len(kept)
            kept.append({**row, "alternates": []})
            sets.append(words)
        else:
            kept[at]["alternates"].append(row["document_id"])
            removed.append({**row, "duplicate_of": kept[at]["document_id"], "reason": reason})
    return kept, removed


def deduplicate_ranked(rows: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """The same for a batch: rows (query_id, position, document_id, content_id, text), a bounded list a query."""
    ship(rows.sparkSession)
    kind = rows.schema["query_id"].dataType.simpleString()
    schema = f"query_id {kind}, position long, document_id string, kept boolean, duplicate_of string, reason string, alternates array<string>"

    def one(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("position").to_dict("records")
        kept, removed = deduplicate(ordered, threshold)
        out = [(r["query_id"], r["position"], r["document_id"], True, None, None, list(dict.fromkeys(r["alternates"]))) for r in kept]
        out += [(r["query_id"], r["position"], r["document_id"], False, r["duplicate_of"], r["reason"], []) for r in removed]
        return pd.DataFrame(out, columns=["query_id", "position", "document_id", "kept", "duplicate_of", "reason", "alternates"])

    picked = rows.select("query_id", F.col("position").cast("long").alias("position"), F.col("document_id").cast("string").alias("document_id"), "content_id", "text")
    return picked.groupBy("query_id").applyInPandas(one, schema)
