"""A collection of corpora behind one object: search in batches, reads of documents and contexts, and status."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.ranking import route
from quarry.functions.text import content_id
from quarry.operators import citations, corpus, fusion, lexical, semantic
from quarry.plans.search import search_documents
from quarry.runtime import ship, stored

RETRIEVALS = ("auto", "bm25", "semantic", "hybrid")
MODES = ("and", "or", "phrase", "exact")
MOST_LIMIT, MOST_QUERY = 50, 2000
EXACT = ("exact_title", "relaxed_exact_title")


class RetrievalUnavailable(RuntimeError):
    """No vector can be had for a query: a semantic search is answered by the inverted index instead."""


@dataclass(frozen=True)
class Found:
    """The answer to a query: rows, what each corpus did, and the rows set aside as near copies."""

    results: DataFrame
    retrieval: dict[str, dict]
    duplicates: DataFrame | None
    reranked: bool


@dataclass
class Corpus:
    """One member: its chunks, its inverted index and, if it has one, its vectors."""

    name: str
    chunks: DataFrame  # row_id, document_id, title, heading, text, ordinal, front_matter
    index: lexical.Index
    vectors: DataFrame | None = None  # vec_id (a row_id), embedding
    aliases: dict[str, str] = field(default_factory=dict)
    pattern: str | None = None
    relax: bool = True  # whether a query that only the inverted index answers may be relaxed

    def rewrite(self, query: str) -> str:
        """Aliases as whole words, letters' case aside, the longest first."""
        for source in sorted(self.aliases, key=len, reverse=True):
            query = re.sub(rf"(?i)(?<!\w){re.escape(source)}(?!\w)", lambda _, s=source: self.aliases[s], query)
        return query


class Collection:
    def __init__(self, spark: SparkSession, corpora: Sequence[Corpus], provider: Callable[[list[str]], np.ndarray] | None = None, cache: int = 256):
        names = [c.name for c in corpora]
        if len(set(names)) != len(names) or not names:
            raise ValueError("corpora need names of their own")
        for c in corpora:
            if any(len(a) > 200 for a in c.aliases) or (c.pattern and len(c.pattern) > 1000):
                raise ValueError(f"{c.name}: an alias or pattern is too long")
        if not 0 <= cache <= 4096:
            raise ValueError("the cache holds 0 to 4096 queries")
        self.spark, self.corpora, self.provider = spark, {c.name: c for c in corpora}, provider
        self._embed = lru_cache(maxsize=cache)(lambda query: provider([query])[0] if provider else None)

    def select(self, query: str, names: Sequence[str] | None = None) -> tuple[list[Corpus], str]:
        """The corpora that a query goes to: those named, else those whose pattern it meets, else all."""
        if names is not None:
            unknown = [n for n in names if n not in self.corpora]
            if unknown:
                raise KeyError(f"unknown corpora: {', '.join(unknown)}")
            return [self.corpora[n] for n in names], "named"
        met = [c for c in self.corpora.values() if c.pattern and re.search(c.pattern, query, re.I)]
        return (met, "pattern") if met else (list(self.corpora.values()), "all")

    def _lexical(self, c: Corpus, query: str, mode: str, limit: int, relax: bool) -> DataFrame:
        """(query_id, document_id, row_id, rank, exact_title) by the inverted index."""
        candidates = min(400, max(80, 20 * limit))
        if mode == "and":
            asked = self.spark.createDataFrame([("q", list(lexical.plan_query(query, mode).terms))], "query_id string, terms array<string>")
            ranked = search_documents(c.index, asked, c.chunks, limit, candidates, relax).withColumn("rank", F.col("position"))
        else:
            chunks = lexical.search(c.index, lexical.plan_queries(self.spark, [("q", query, mode)]), candidates, chunks=c.chunks)
            ranked = fusion.first_per_document(chunks).where(F.col("rank") <= limit)
        return ranked.select("query_id", "document_id", "row_id", "rank", F.col("reason").isin(*EXACT).alias("exact_title"))

    def _semantic(self, c: Corpus, query: str, limit: int) -> DataFrame:
        """The same by vectors; :class:`RetrievalUnavailable` if the provider fails or its vector does not fit."""
        try:
            vector = [float(x) for x in self._embed(query)]
        except Exception as error:
            raise RetrievalUnavailable(f"the provider failed: {error}") from error
        one = c.vectors.select(F.size("embedding").alias("n")).first()
        if one and one["n"] != len(vector):
            raise RetrievalUnavailable(f"the query has {len(vector)} dimensions, the index {one['n']}")
        asked = self.spark.createDataFrame([(0, vector)], "query_id long, embedding array<double>")
        pool = semantic.top_k(c.vectors, asked, semantic.pool_size(max(1, c.vectors.count()), limit), most=semantic.MOST_POOL)
        owned = pool.join(c.chunks.select(F.col("row_id").alias("vec_id"), "document_id"), "vec_id")
        best = semantic.best_per_group(owned, "document_id", limit)
        return best.select(F.lit("q").alias("query_id"), "document_id", F.col("vec_id").alias("row_id"), "rank", F.lit(False).alias("exact_title"))

    def _one(self, c: Corpus, query: str, how: str, mode: str, limit: int) -> DataFrame:
        """A corpus' own list, with ``dual``: whether both rankings have the document."""
        if how == "semantic":
            return self._semantic(c, query, limit).withColumn("dual", F.lit(False))
        if how == "bm25":
            return self._lexical(c, query, mode, limit, c.relax).withColumn("dual", F.lit(False))
        by_vector = self._semantic(c, query, limit)
        by_word = self._lexical(c, query, mode, limit, True)
        fused = fusion.reciprocal_rank_fusion({"lexical": (by_word, 1.0), "semantic": (by_vector, 1.0)}, limit)
        word, vector = (r.select("document_id", F.col("row_id").alias(n)) for r, n in ((by_word, "word_row"), (by_vector, "vector_row")))
        titled = by_word.where("exact_title").select("document_id", F.lit(True).alias("titled"))
        joined = fused.join(word, "document_id", "left").join(vector, "document_id", "left").join(titled, "document_id", "left")
        return joined.select(
            "query_id", "document_id", F.coalesce("word_row", "vector_row").alias("row_id"), F.col("position").alias("rank"), F.coalesce("titled", F.lit(False)).alias("exact_title"),
            (F.col("lexical_rank").isNotNull() & F.col("semantic_rank").isNotNull()).alias("dual"),
        )

    def find(self, query: str, limit: int = 8, mode: str = "and", retrieval: str = "auto", names: Sequence[str] | None = None, rerank: bool = True, deduplicate: bool = True) -> Found:
        """The best documents of all selected corpora. Each gives a pool of more than ``limit``; pools are fused by rank,
        exact titles first, reranked by evidence unless one corpus was searched by words alone, rid of near copies, and
        then cut. Rows: position, corpus, document_id, row_id, rank (in the corpus), federation_score, rerank_score,
        title, heading, text, alternates, citation, label, markdown."""
        query = query.strip()
        if not query or len(query) > MOST_QUERY or not 1 <= limit <= MOST_LIMIT or retrieval not in RETRIEVALS or mode not in MODES:
            raise ValueError("query, mode, limit or retrieval is out of bounds")
        chosen, corpus_route = self.select(query, names)
        pool = min(MOST_LIMIT, max(32, 4 * limit))
        per_corpus, state = {}, {}
        for c in chosen:
            asked = c.rewrite(query)
            wanted = self.route(asked, c, mode) if retrieval == "auto" else retrieval
            how, why = wanted, None
            if how != "bm25" and (c.vectors is None or self.provider is None):
                how, why = "bm25", f"{wanted} is not configured for the corpus"
            try:
                per_corpus[c.name] = self._one(c, asked, how, mode, pool)
            except RetrievalUnavailable as error:
                how, why = "bm25", str(error)
                per_corpus[c.name] = self._one(c, asked, how, mode, pool)
            state[c.name] = {"requested": wanted, "used": how, "fallback_reason": why, "query": asked, "corpus_route": corpus_route}
        pools = {name: stored(df, f"pool-{i}") for i, (name, df) in enumerate(per_corpus.items())}
        fused = fusion.federate(pools, None)
        texts = functools.reduce(DataFrame.unionByName, (self._texts(c, pools[c.name]) for c in chosen))
        extra = functools.reduce(DataFrame.unionByName, (df.select(F.lit(name).alias("corpus"), "document_id", "row_id", "dual") for name, df in pools.items()))
        rows = fused.join(extra, ["corpus", "document_id"]).join(texts, ["corpus", "row_id"]).withColumn("base_score", F.col("federation_score"))
        reranked = rerank and not (len(chosen) == 1 and state[chosen[0].name]["used"] == "bm25")
        if reranked:
            rows = fusion.rerank(rows, F.lit(query)).withColumn("position", F.col("rerank_position"))
        else:
            rows = rows.withColumn("rerank_score", F.lit(None).cast("double"))
        rows = stored(rows.withColumn("key", F.concat_ws("\x1f", "corpus", F.col("document_id").cast("string"))), "ranked-pool")
        removed = None
        if deduplicate:
            ship(self.spark)
            judged = fusion.deduplicate_ranked(rows.select("query_id", "position", F.col("key").alias("document_id"), content_id(F.col("text")).alias("content_id"), "text"))
            judged = stored(judged.withColumnRenamed("document_id", "key"), "judged-pool")
            rows = rows.join(judged.where("kept").select("key", "alternates"), "key")
            removed = judged.where("NOT kept").select("position", "key", "duplicate_of", "reason")
        else:
            rows = rows.withColumn("alternates", F.array().cast("array<string>"))
        rows = rows.withColumn("position", F.row_number().over(Window.partitionBy("query_id").orderBy("position"))).where(F.col("position") <= limit)
        none = F.lit(None).cast("string")
        path = F.when(F.length("heading") > 0, F.split("heading", " > ")).otherwise(F.array().cast("array<string>"))
        rows = rows.withColumn("citation", citations.citation(F.col("corpus"), F.col("title"), path, F.col("revision"), F.col("url"), none))
        lines = citations.numbered(rows.select("query_id", "position", "citation", "url")).select("citation", F.col("url").alias("cited_url"), "label", "markdown")
        rows = rows.join(lines, ["citation"]).where(F.col("url").eqNullSafe(F.col("cited_url")))
        columns = ["position", "corpus", "document_id", "row_id", "rank", "federation_score", "rerank_score", "title", "heading", "text", "alternates", "citation", "label", "markdown"]
        return Found(rows.select(*columns).orderBy("position"), state, removed, reranked)

    def _texts(self, c: Corpus, pool: DataFrame) -> DataFrame:
        """What the rows of a pool say, with url and revision if the corpus has them."""
        own = lambda name: F.col(name) if name in c.chunks.columns else F.lit(None).cast("string")
        some = c.chunks.join(pool.select("row_id").distinct(), "row_id", "left_semi")
        return some.select(F.lit(c.name).alias("corpus"), "row_id", "title", F.coalesce("heading", F.lit("")).alias("heading"), "text", own("url").alias("url"), own("revision").alias("revision"))

    def search(self, query: str, limit: int = 8, mode: str = "and", retrieval: str = "auto", names: Sequence[str] | None = None, rerank: bool = True, deduplicate: bool = True) -> DataFrame:
        """The rows of :meth:`find`."""
        return self.find(query, limit, mode, retrieval, names, rerank, deduplicate).results

    def route(self, query: str, c: Corpus, mode: str) -> str:
        retrieval, _ = route(F.lit(query), F.lit(c.name), F.lit(c.vectors is not None), F.lit(mode))
        return self.spark.range(1).select(retrieval.alias("r")).first()["r"]

    def document(self, name: str, document_id, offset: int = 0, limit: int = 50) -> DataFrame:
        page = corpus.document_page(self.corpora[name].chunks, document_id, offset, limit)
        if offset == 0 and page.limit(1).count() == 0:
            raise KeyError(document_id)
        return page

    def context(self, name: str, row_id, before: int = 1, after: int = 1) -> DataFrame:
        chunks = self.corpora[name].chunks
        anchor = chunks.where(F.col("row_id") == row_id)
        if anchor.limit(1).count() == 0:
            raise KeyError(row_id)
        return corpus.context(chunks, anchor, before, after).orderBy("ordinal")

    def status(self) -> DataFrame:
        rows = [(c.name, c.chunks.select("document_id").distinct().count(), c.chunks.count(), c.vectors is not None) for c in self.corpora.values()]
        return self.spark.createDataFrame(rows, "corpus string, documents long, chunks long, semantic boolean")
