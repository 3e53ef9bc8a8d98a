"""Registered queries over the supplied tables, each with the SQL that it is held against where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import ranking, text, vectors
from quarry.operators import citations, corpus, evaluation, fusion, lexical, semantic
from quarry.plans.tables import benchmark_terms, table, text_chunks, turn_chunks
from quarry.runtime import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_TOKENS = "regexp_extract_all(strip_accents(lower({})), '[\\p{{L}}\\p{{N}}\\p{{Co}}]+')"
_STOP = "[" + ", ".join(f"'{w}'" for w in lexical.STOP_WORDS) + "]"


def tokens_sql(column: str) -> str:
    return _TOKENS.format(column)


_NORMAL = "regexp_replace(regexp_replace(replace(replace(nfc_normalize(coalesce(text, '')), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \\t]+\\n', chr(10), 'g'), '^\\s+|\\s+$', '', 'g')"


# identities, records and sources


@query(f"SELECT doc_id, 'sha256:' || sha256({_NORMAL}) AS content_id FROM documents")
def content_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return table(spark, sf_dir, "documents").select("doc_id", text.content_id(F.col("text")).alias("content_id"))


@query(f"""SELECT content_id, count(*) AS copies, min(doc_id) AS first_id FROM (SELECT doc_id, 'sha256:' || sha256({_NORMAL}) AS content_id FROM documents)
GROUP BY content_id HAVING count(*) > 1""")
def exact_dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_id(spark, sf_dir).groupBy("content_id").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


@query("""SELECT doc_id, 'docs:' || left(sha256(lower(source || '/' || doc_id)), 24) AS document_id,
left(sha256(to_json([source, lang, CAST(doc_id AS VARCHAR)])), 32) AS chunk_instance_id FROM documents""")
def record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = F.lower(F.concat_ws("/", "source", F.col("doc_id").cast("string")))
    packed = F.to_json(F.array("source", "lang", F.col("doc_id").cast("string")))
    return docs.select(
        "doc_id", F.concat(F.lit("docs:"), F.substring(F.sha2(path.cast("binary"), 256), 1, 24)).alias("document_id"), F.substring(F.sha2(packed.cast("binary"), 256), 1, 32).alias("chunk_instance_id")
    )


@query("""SELECT doc_id, list_filter(['text', 'lang', 'n_chars'], lambda p:
  CASE p WHEN 'text' THEN text IS NULL OR trim(text) = '' WHEN 'lang' THEN lang IS NULL OR lang = '' ELSE n_chars IS NULL OR n_chars <> length(text) END) AS problems FROM documents""".replace("list_filter", "array_to_string(list_filter").replace("END) AS", "END), ',') AS"))
def record_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required texts that are missing, and character counts that do not hold."""
    empty = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    wrong = [F.when(empty(F.col("text")), "text"), F.when(empty(F.col("lang")), "lang"), F.when(~F.coalesce(F.col("n_chars") == F.length("text"), F.lit(False)), "n_chars")]
    return table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(",", *wrong).alias("problems"))


@query("SELECT lang, source, count(*) AS n, sum(n_chars) AS chars FROM documents GROUP BY lang, source")
def format_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT DISTINCT source FROM documents ORDER BY source")
def corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("source").distinct().orderBy("source")


@query("""WITH p AS (SELECT source, sum(n_chars) AS bytes FROM documents GROUP BY source)
SELECT count(*) AS sampled_parts, sum(bytes) AS sampled_bytes, CAST(floor(sum(bytes) * 1000.0 / count(*)) AS BIGINT) AS projected_bytes FROM p""")
def storage_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum("n_chars").alias("bytes"))
    return corpus.storage_projection(parts, F.lit(1000.0)).withColumn("projected_bytes", F.col("projected_bytes").cast("long"))


# lexical retrieval


@query(f"SELECT doc_id, len(t) AS n_tokens, sha256(array_to_string(t, ' ')) AS tokens_sha256 FROM (SELECT doc_id, {tokens_sql('text')} AS t FROM documents)")
def tokenize_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tokens of each document, as a hash."""
    return table(spark, sf_dir, "documents").select("doc_id", text.tokens(F.col("text")).alias("t")).select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.sha2(F.array_join("t", " ").cast("binary"), 256).alias("tokens_sha256"))


@query(f"SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM (SELECT doc_id, unnest({tokens_sql('text')}) AS term FROM documents) GROUP BY term")
def term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_doc = table(spark, sf_dir, "documents").select("doc_id", F.explode(text.tokens(F.col("text"))).alias("term")).groupBy("term", "doc_id").agg(F.count(F.lit(1)).alias("tf"))
    return per_doc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


_DL = f"SELECT doc_id, len({tokens_sql('source')}) + len({tokens_sql('lang')}) + len({tokens_sql('text')}) AS dl FROM documents"


@query(f"SELECT count(*) AS n, round(sum(dl) / count(*), 6) AS avgdl FROM ({_DL})")
def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_index(spark, sf_dir).corpus.select("n", F.round("avgdl", 6).alias("avgdl"))


@query(f"""SELECT item_id, array_to_string(CASE WHEN len(k) > 0 THEN k ELSE t END, ' ') AS terms FROM (
SELECT item_id, t, list_filter(t, lambda x: NOT list_contains({_STOP}, x)) AS k FROM (SELECT item_id, {tokens_sql('text')} AS t FROM benchmark))""")
def query_plan_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(lexical.plan_terms(F.col("text")), " ").alias("terms"))


@query()
def technical_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with signs in whole documents; the rows are held against the plain version in the tests."""
    ship(spark)
    return table(spark, sf_dir, "documents").select("doc_id", text.technical_normalized(F.col("text")).alias("technical"))


_FIELDS = {"title": "title", "heading": "heading", "text": "text"}


def _plain_index(spark: SparkSession, sf_dir: str, terms: DataFrame | None = None) -> lexical.Index:
    """For a batch of AND and OR queries: the postings of their terms, stored."""
    return lexical.build_index(text_chunks(spark, sf_dir), _FIELDS, terms, positions=False)


def _bm25_sql(mode: str, limit: int = 10) -> str:
    return f"""
WITH f AS (
  SELECT doc_id, 5.0 AS w, {tokens_sql("coalesce(source, '')")} AS t FROM documents UNION ALL
  SELECT doc_id, 2.0, {tokens_sql("coalesce(lang, '')")} FROM documents UNION ALL
  SELECT doc_id, 1.0, {tokens_sql("coalesce(text, '')")} FROM documents
), dl AS (SELECT doc_id, sum(len(t)) AS dl FROM f GROUP BY doc_id),
s AS (SELECT count(*) AS n, sum(dl) / count(*) AS avgdl FROM dl),
plan AS (
  SELECT item_id, CASE WHEN len(k) > 0 THEN k ELSE t END AS terms FROM (
    SELECT item_id, t, list_filter(t, lambda x: NOT list_contains({_STOP}, x)) AS k FROM (SELECT item_id, {tokens_sql('text')} AS t FROM benchmark))
), q AS (SELECT item_id, unnest(terms) AS term, generate_subscripts(terms, 1) AS pos FROM plan),
p AS (SELECT term, doc_id, sum(w) AS f FROM (SELECT doc_id, w, unnest(t) AS term FROM f) WHERE term IN (SELECT term FROM q) GROUP BY term, doc_id),
d AS (SELECT term, count(*) AS df FROM p GROUP BY term),
h AS (
  SELECT q.item_id, p.doc_id, count(*) AS matched,
         -sum((CASE WHEN ln((n - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df + 0.5) / (df + 0.5)) END) * p.f * 2.2 / (p.f + 1.2 * (0.25 + 0.75 * dl.dl / avgdl))) AS score
  FROM q JOIN p USING (term) JOIN d USING (term) JOIN dl ON dl.doc_id = p.doc_id, s GROUP BY q.item_id, p.doc_id
), m AS (
  SELECT h.* FROM h JOIN plan USING (item_id) WHERE {'true' if mode == 'or' else 'matched = len(terms)'}
), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9), doc_id) AS rank FROM m)
SELECT item_id AS query_id, doc_id AS row_id, round(score, 6) AS score, rank FROM r WHERE rank <= {limit}"""


def _bm25(spark: SparkSession, sf_dir: str, mode: str, limit: int = 10) -> DataFrame:
    terms = benchmark_terms(spark, sf_dir, mode)
    found = lexical.search(_plain_index(spark, sf_dir, terms), terms, limit)
    return found.select("query_id", "row_id", F.round("raw_score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(_bm25_sql("or"))
def bm25_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term of every passage."""
    return _bm25(spark, sf_dir, "or")


@query(_bm25_sql("and"))
def bm25_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bm25(spark, sf_dir, "and")


@query()
def bm25_four_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the field of technical names; held against SQLite's own ranking in the tests."""
    terms = benchmark_terms(spark, sf_dir, "or")
    found = lexical.search(lexical.build_index(text_chunks(spark, sf_dir), terms=terms, positions=False), terms, 10)
    return found.select("query_id", "row_id", F.round("raw_score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(f"""
WITH t AS (SELECT doc_id, {tokens_sql("coalesce(text, '')")} AS t FROM documents),
plan AS (SELECT item_id, p, len(p) AS n FROM (SELECT item_id, {tokens_sql("coalesce(text, '')")} AS p FROM benchmark) WHERE len(p) > 0),
s AS (SELECT count(*) AS n_docs, sum(len(t)) / count(*) AS avgdl FROM t),
c AS (SELECT item_id, doc_id, t, p, n FROM plan JOIN t ON contains(' ' || array_to_string(t, ' ') || ' ', ' ' || array_to_string(p, ' ') || ' ')),
h AS (SELECT item_id, doc_id, len(t) AS dl, len(list_filter(range(1, len(t) - n + 2), lambda i: t[i:i + n - 1] = p)) AS f, count(*) OVER (PARTITION BY item_id) AS df FROM c),
r AS (SELECT item_id, doc_id, -(CASE WHEN ln((n_docs - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n_docs - df + 0.5) / (df + 0.5)) END) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / avgdl)) AS score FROM h, s),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9), doc_id) AS rank FROM r)
SELECT item_id AS query_id, doc_id AS row_id, round(score, 6) AS score, rank FROM k WHERE rank <= 10""")
def bm25_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole passages as phrases, stop words and all."""
    terms = benchmark_terms(spark, sf_dir, "phrase")
    index = lexical.build_index(text_chunks(spark, sf_dir), {"text": "text"}, terms)
    found = lexical.search(index, terms, 10)
    return found.select("query_id", "row_id", F.round("raw_score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("""WITH asked AS (SELECT DISTINCT source AS query_id, lower(source) AS asked FROM documents),
m AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS k FROM asked JOIN documents ON lower(source) = asked)
SELECT query_id, doc_id AS row_id FROM m WHERE k = 1""")
def title_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries that are titles: the first chunk of the title's document comes first."""
    chunks = text_chunks(spark, sf_dir)
    terms = chunks.select(F.col("title").alias("query_id")).distinct().select("query_id", F.lit("and").alias("mode"), F.posexplode(text.tokens(F.col("query_id"))).alias("pos", "term"))
    found = lexical.match_terms(lexical.build_index(chunks, {"title": "title"}), terms)
    return lexical.promoted_titles(found, terms, chunks).select("query_id", "row_id")


@query()
def query_relaxation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AND queries of whole passages, with their relaxed variants in one plan."""
    from quarry.plans.search import search_documents

    rows = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), lexical.plan_terms(F.col("text")).alias("terms"))
    index = _plain_index(spark, sf_dir, rows.select(F.explode("terms").alias("term")))
    found = search_documents(index, rows, text_chunks(spark, sf_dir), limit=5)
    return found.select("query_id", "document_id", F.round("fusion_score", 9).alias("fusion_score"), "position", "relaxed", F.array_join("matched_variants", "|").alias("matched_variants"), "reason")


# vectors


@query("""SELECT vec_id, round(list_sum(list_transform(e, lambda x: x * x)), 6) AS squared, round(e[1], 6) AS first_value FROM (
SELECT vec_id, list_transform(d, lambda x: x / sqrt(list_sum(list_transform(d, lambda y: y * y)))) AS e FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS d FROM embeddings))""")
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = table(spark, sf_dir, "embeddings").select("vec_id", vectors.normalize(F.col("embedding")).alias("e"))
    return unit.select("vec_id", F.round(vectors.dot(F.col("e"), F.col("e")), 6).alias("squared"), F.round(F.get("e", 0), 6).alias("first_value"))


_UNIT = "SELECT vec_id, label, list_transform(d, lambda x: x / sqrt(list_sum(list_transform(d, lambda y: y * y)))) AS e FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS d FROM embeddings)"
_TOP = f"""WITH v AS ({_UNIT}), s AS (SELECT q.vec_id AS query_id, v.vec_id, v.label, list_dot_product(q.e, v.e) AS score FROM v q, v WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS rank FROM s)"""


_DUE = "vec_id % 50 = 0"


def _vector_top(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    """Every fiftieth vector against all vectors."""
    every = table(spark, sf_dir, "embeddings")
    return semantic.top_k(every, every.where(_DUE).select(F.col("vec_id").alias("query_id"), "embedding"), limit)


_TOP_TEN = " SELECT query_id, vec_id, round(score, 6) AS score, rank FROM r WHERE rank <= 10"


@query(_TOP + _TOP_TEN)
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_top(spark, sf_dir, 10).select("query_id", "vec_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


_BEST = """, b AS (SELECT *, row_number() OVER (PARTITION BY query_id, label ORDER BY rank) AS k FROM r WHERE rank <= 256),
c AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS place FROM b WHERE k = 1)
SELECT query_id, vec_id, label, place AS rank FROM c WHERE place <= 4"""


@query(_TOP + _BEST)
def vector_best_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = _vector_top(spark, sf_dir, 256).join(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "vec_id")
    return semantic.best_per_group(pool, "label", 4).select("query_id", "vec_id", "label", F.col("rank").cast("long").alias("rank"))


@query("""WITH o AS (SELECT label, min(vec_id) AS vector_id FROM embeddings WHERE vec_id % 3 <> 0 GROUP BY label)
SELECT vec_id AS id, CAST(e.label AS VARCHAR) AS fingerprint, vector_id FROM embeddings e LEFT JOIN o ON e.label = o.label""")
def vector_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new generation of all vectors against an old one of two thirds, by fingerprint."""
    every = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("fingerprint"))
    old = every.where("id % 3 <> 0").withColumn("vector_id", F.col("id"))
    return semantic.reuse_plan(every, old, by_document=False).select("id", "fingerprint", "vector_id")


@query("SELECT count(*) AS n, min(vec_id) AS least, max(vec_id) AS most, count(DISTINCT vec_id) AS ids, count(*) FILTER (len(embedding) <> 64 OR list_bool_or(list_transform(embedding, lambda x: NOT isfinite(x))) OR list_sum(list_transform(embedding, lambda x: x * x)) = 0) AS unusable, count(*) = count(DISTINCT vec_id) AND min(vec_id) = 0 AND max(vec_id) = count(*) - 1 AS contiguous FROM embeddings")
def vector_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.verify_vectors(table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "vector_id"), 64)


# fusion


_ROUTED = f"bm25 AS ({_bm25_sql('or', 50)}), vec AS ({_TOP} SELECT query_id, vec_id AS row_id, rank FROM r WHERE rank <= 50)"


def _rankings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lexical and vector rankings; a vector stands for the document of its id."""
    lexical_rank = _bm25(spark, sf_dir, "or", 50).select("query_id", F.col("row_id").alias("document_id"), "rank")
    vector_rank = _vector_top(spark, sf_dir, 50).select("query_id", F.col("vec_id").alias("document_id"), "rank")
    return lexical_rank, vector_rank


def _rrf_sql(w_lexical: float, w_vector: float) -> str:
    return f"""WITH {_ROUTED},
a AS (SELECT query_id, row_id, rank, {w_lexical} AS w, 1 AS l FROM bm25 UNION ALL SELECT query_id, row_id, rank, {w_vector}, 0 FROM vec),
f AS (SELECT query_id, row_id, sum(w / (60 + rank)) AS score, min(CASE WHEN l = 1 THEN rank END) AS lexical_rank, min(CASE WHEN l = 0 THEN rank END) AS vector_rank FROM a GROUP BY query_id, row_id),
p AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, row_id) AS position FROM f)
SELECT query_id, row_id AS document_id, round(score, 9) AS fusion_score, lexical_rank, vector_rank, position FROM p WHERE position <= 10"""


def _rrf(spark: SparkSession, sf_dir: str, w_lexical: float, w_vector: float) -> DataFrame:
    a, b = _rankings(spark, sf_dir)
    fused = fusion.reciprocal_rank_fusion({"lexical": (a, w_lexical), "vector": (b, w_vector)}, 10)
    return fused.select("query_id", "document_id", F.round("fusion_score", 9).alias("fusion_score"), "lexical_rank", "vector_rank", F.col("position").cast("long").alias("position"))


@query(_rrf_sql(1.0, 1.0))
def rrf_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rrf(spark, sf_dir, 1.0, 1.0)


@query(_rrf_sql(0.7, 1.3))
def rrf_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rrf(spark, sf_dir, 0.7, 1.3)


def _federated_sql() -> str:
    return f"""WITH {_ROUTED},
a AS (SELECT query_id, row_id, rank, 'lexical' AS corpus, 0 AS o FROM bm25 UNION ALL SELECT query_id, row_id, rank, 'vector', 1 FROM vec),
p AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY 1.0 / (60 + rank) DESC, o, row_id) AS position FROM a)
SELECT query_id, row_id AS document_id, corpus, position FROM p WHERE position <= 12"""


@query(_federated_sql())
def rrf_federated(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (r.withColumn("exact_title", F.lit(False)) for r in _rankings(spark, sf_dir))
    return fusion.federate({"lexical": a, "vector": b}, 12).select("query_id", "document_id", "corpus", F.col("position").cast("long").alias("position"))


_QTOK = "regexp_extract_all(lower({}), '[A-Za-z0-9]+(?:[._:/+#-][A-Za-z0-9]+)*')"
_RSTOP = "[" + ", ".join(f"'{w}'" for w in ranking.STOP_WORDS) + "]"
_RQUESTION = "[" + ", ".join(f"'{w}'" for w in ranking.QUESTION_WORDS) + "]"


@query()
def route_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages and the addresses of pages, which bear identifiers, whole and unaltered; held against a plain version
    in the tests."""
    passages = table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("kind"), F.col("item_id").alias("item_id"), F.col("text").alias("q"))
    addresses = table(spark, sf_dir, "pages").select(F.lit("pages").alias("kind"), F.col("page_id").alias("item_id"), F.col("url").alias("q"))
    retrieval, reason = ranking.route(F.coalesce("q", F.lit("")), F.lit("docs"), F.lit(True), F.lit("and"))
    return passages.unionByName(addresses).select("kind", "item_id", retrieval.alias("retrieval"), reason.alias("reason"))


#: As RE2 has it; the column's pattern knows letters beyond ASCII, too, which no identifier of the passages has.
_IDENT = r"(?:\b[A-Z][A-Z0-9_]{2,}\b|\b[A-Za-z][A-Za-z0-9]*_[A-Za-z0-9_]+\b|\b\w+::\w+\b|--[a-z0-9][\w-]*|(?i:\bRFC\s*)?\d{2,5}\b|\b\w+\.\w+\b|(?i:\bC\+\+|\bC#|\.NET\b))"


def _rerank_sql() -> str:
    return f"""WITH {_ROUTED},
q AS (SELECT item_id, text || ' ' || CASE item_id % 3 WHEN 0 THEN 'RFC 793' WHEN 1 THEN 'std::vector foo_bar' ELSE '' END AS q FROM benchmark),
t AS (SELECT item_id, {_QTOK.format('q')} AS t, list_distinct(list_transform(regexp_extract_all(q, '{_IDENT}'), lambda x: lower(x))) AS names FROM q),
m AS (SELECT item_id, names, list_distinct(CASE WHEN len(k) > 0 THEN k ELSE t END) AS w FROM (SELECT item_id, t, names, list_filter(t, lambda x: NOT list_contains({_RSTOP}, x)) AS k FROM t)),
c AS (SELECT b.query_id, b.row_id, b.rank, w, names, 1.0 / (60 + b.rank) AS base, v.rank IS NOT NULL AS dual, b.row_id % 5 = b.query_id % 5 AS titled, {_QTOK.format('source')} AS ti, {_QTOK.format('lang')} AS he, {_QTOK.format('x')} AS te,
        lower(source || ' ' || lang || ' ' || x) AS searched
      FROM (SELECT * FROM bm25 WHERE rank <= 20) b JOIN m ON m.item_id = b.query_id
      JOIN (SELECT *, text || CASE doc_id % 4 WHEN 0 THEN ' rfc 793' WHEN 1 THEN ' FOO_BAR' ELSE '' END AS x FROM documents) d ON d.doc_id = b.row_id LEFT JOIN vec v ON v.query_id = b.query_id AND v.row_id = b.row_id),
s AS (SELECT query_id, row_id, rank, base + least(0.0015, 0.008 * len(list_intersect(w, ti)) / len(w) + 0.004 * len(list_intersect(w, he)) / len(w) + 0.0015 * len(list_intersect(w, te)) / len(w) + CASE WHEN dual THEN 0.002 ELSE 0 END)
        + CASE WHEN len(names) = 0 THEN 0 ELSE 0.035 * len(list_filter(names, lambda x: contains(searched, x))) / len(names) END + CASE WHEN titled THEN 0.10 ELSE 0 END AS score FROM c),
p AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, rank) AS place FROM s)
SELECT query_id, row_id AS document_id, round(score, 9) AS rerank_score, place AS rerank_position FROM p WHERE place <= 10"""


@query(_rerank_sql())
def rerank_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best twenty documents of each passage by their evidence. Two of three queries and half of the documents bear
    technical names besides their own words, one in five is taken for an exact title, and documents that the vector
    ranking has, too, are known by both, so that every feature counts."""
    ranked, by_vector = _rankings(spark, sf_dir)
    ranked = ranked.where("rank <= 20").join(by_vector.select("query_id", "document_id", F.lit(True).alias("dual")), ["query_id", "document_id"], "left")
    kind = lambda c, n: F.col(c) % n
    more = F.when(kind("item_id", 3) == 0, "RFC 793").when(kind("item_id", 3) == 1, "std::vector foo_bar").otherwise("")
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.concat("text", F.lit(" "), more).alias("query"))
    also = F.when(kind("row_id", 4) == 0, " rfc 793").when(kind("row_id", 4) == 1, " FOO_BAR").otherwise("")
    texts = text_chunks(spark, sf_dir).select("document_id", "title", "heading", F.concat("text", also).alias("text"))
    rows = ranked.join(asked, "query_id").join(texts, "document_id").select(
        "query_id", "document_id", F.col("rank").alias("position"), (1 / (fusion.RRF_K + F.col("rank"))).alias("base_score"), "title", "heading", "text", "query",
        F.coalesce("dual", F.lit(False)).alias("dual"), (kind("document_id", 5) == kind("query_id", 5)).alias("exact_title"), F.lit("docs").alias("corpus"),
    )
    found = fusion.rerank(rows).where("rerank_position <= 10")
    return found.select("query_id", "document_id", F.round("rerank_score", 9).alias("rerank_score"), F.col("rerank_position").cast("long").alias("rerank_position"))


@query()
def evidence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best twenty passages of each query, near copies set aside; order decides, so SQL cannot express it."""
    ranked = _bm25(spark, sf_dir, "or", 20).select("query_id", F.col("rank").alias("position"), "row_id")
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text")
    rows = ranked.join(texts, "row_id").select("query_id", "position", F.col("row_id").cast("string").alias("document_id"), text.content_id(F.col("text")).alias("content_id"), "text")
    return fusion.deduplicate_ranked(rows).withColumn("alternates", F.array_join("alternates", ","))


@query("""WITH p AS (SELECT page_id, url, coalesce(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title FROM pages),
c AS (SELECT CAST(page_id % 10 AS BIGINT) AS query_id, page_id AS position, 'pages — ' || trim(regexp_replace(title, '\\s+', ' ', 'g')) || ' ' || url AS citation, url FROM p),
f AS (SELECT query_id, citation, url, min(position) AS position FROM c GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY position, citation) AS k FROM f)
SELECT query_id, position, 'S' || k AS label, '[S' || k || '] ' || regexp_replace(citation, '([\\\\\\[\\]])', '\\\\\\1', 'g') || ' <' || url || '>' AS markdown FROM n""")
def copy_ready_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = text.collapse(F.coalesce(F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1), F.lit("")))
    none = F.lit(None).cast("string")
    cited = citations.citation(F.lit("pages"), title, F.array().cast("array<string>"), none, F.col("url"), none)
    rows = table(spark, sf_dir, "pages").select((F.col("page_id") % 10).alias("query_id"), F.col("page_id").alias("position"), cited.alias("citation"), "url")
    return citations.numbered(rows).select("query_id", "position", "label", "markdown")


# evaluation


def _judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lists of documents ordered by length within a source as rankings, labels as grades."""
    from pyspark.sql import Window

    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("query_id"), F.col("doc_id").alias("document_id"), "n_chars")
    order = Window.partitionBy("query_id").orderBy(F.col("n_chars").desc(), "document_id")
    ranked = docs.withColumn("rank", F.row_number().over(order)).where("rank <= 50").drop("n_chars")
    labels = table(spark, sf_dir, "labels").where("quality >= 1").select(F.col("doc_id").alias("document_id"), F.col("quality").alias("grade"))
    return ranked, docs.drop("n_chars").join(labels, "document_id")


_METRICS = """r AS (SELECT * FROM (SELECT source AS query_id, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 50),
j AS (SELECT d.source AS query_id, d.doc_id, power(2, l.quality) - 1 AS gain, r.rank FROM documents d JOIN labels l USING (doc_id) LEFT JOIN r USING (doc_id) WHERE l.quality >= 1),
i AS (SELECT query_id, sum(gain / log2(k + 1)) AS ideal FROM (SELECT query_id, gain, row_number() OVER (PARTITION BY query_id ORDER BY gain DESC) AS k FROM j) WHERE k <= 10 GROUP BY query_id),
m AS (SELECT j.query_id, coalesce(max((rank <= 1)::INT), 0)::DOUBLE AS success_1, coalesce(max((rank <= 5)::INT), 0)::DOUBLE AS success_5, coalesce(max((rank <= 10)::INT), 0)::DOUBLE AS success_10,
 sum(coalesce((rank <= 5)::INT, 0)) / count(*) AS recall_5, sum(coalesce((rank <= 10)::INT, 0)) / count(*) AS recall_10, sum(coalesce((rank <= 50)::INT, 0)) / count(*) AS recall_50,
 coalesce(max(CASE WHEN rank <= 10 THEN 1 / rank END), 0) AS mrr_10, sum(CASE WHEN rank <= 10 THEN gain / log2(rank + 1) ELSE 0 END) / max(ideal) AS ndcg_10
 FROM j JOIN i ON i.query_id = j.query_id GROUP BY j.query_id)"""
_NAMES = ("success_1", "success_5", "success_10", "recall_5", "recall_10", "recall_50", "mrr_10", "ndcg_10")


@query(f"WITH {_METRICS} SELECT query_id, {', '.join(f'round({n}, 6) AS {n}' for n in _NAMES)} FROM m")
def ir_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = evaluation.case_metrics(*_judged(spark, sf_dir))
    return cases.select("query_id", *(F.round(n, 6).alias(n) for n in _NAMES))


@query(f"WITH {_METRICS} SELECT length(query_id) AS kind, count(*) AS cases, {', '.join(f'round(avg({n}), 6) AS {n}' for n in _NAMES)} FROM m GROUP BY kind")
def metrics_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = evaluation.case_metrics(*_judged(spark, sf_dir)).withColumn("kind", F.length("query_id").cast("long"))
    return evaluation.mean_metrics(cases, "kind")


@query("SELECT event_type, percentile_disc(0.5) WITHIN GROUP (ORDER BY value) AS p50, percentile_disc(0.95) WITHIN GROUP (ORDER BY value) AS p95, percentile_disc(0.99) WITHIN GROUP (ORDER BY value) AS p99 FROM events GROUP BY event_type")
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.nearest_rank(table(spark, sf_dir, "events"), "value", (50, 95, 99), "event_type")


# ordered chunks


@query("""SELECT conv_id AS document_id, turn AS ordinal, row_number() OVER w - 1 AS dense_ordinal, lag(conv_id || ':' || turn) OVER w AS previous_chunk_id, lead(conv_id || ':' || turn) OVER w AS next_chunk_id
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def neighbor_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = corpus.neighbours(turn_chunks(spark, sf_dir))
    return linked.select("document_id", "ordinal", F.col("dense_ordinal").cast("long").alias("dense_ordinal"), "previous_chunk_id", "next_chunk_id")


@query("""SELECT c.conv_id AS document_id, c.turn AS ordinal, a.turn AS anchor, c.text FROM conversations a JOIN conversations c ON c.conv_id = a.conv_id
AND c.turn >= greatest(0, a.turn - 1) AND c.turn <= greatest(0, a.turn - 1) + 2 WHERE a.role = 'user'""")
def context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = turn_chunks(spark, sf_dir)
    return corpus.context(chunks, chunks.where("role = 'user'"), 1, 1).select("document_id", "ordinal", "anchor", "text")


@query("SELECT turn AS ordinal, text, (SELECT count(*) FROM conversations WHERE conv_id = 3) AS total, 4 < (SELECT count(*) FROM conversations WHERE conv_id = 3) AS has_more FROM conversations WHERE conv_id = 3 ORDER BY turn LIMIT 3 OFFSET 1")
def document_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.document_page(turn_chunks(spark, sf_dir), 3, 1, 3).select("ordinal", "text", "total", "has_more")


@query("SELECT conv_id AS document_id, left('Conversation ' || conv_id || chr(10) || chr(10) || string_agg(text, chr(10) || chr(10) ORDER BY turn), 500) AS embedding_text FROM conversations WHERE turn < 3 GROUP BY conv_id")
def lead_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.lead_text(turn_chunks(spark, sf_dir), 3, 500)


@query("SELECT conv_id AS document_id, turn AS ordinal, left('Title: Conversation ' || conv_id || chr(10) || 'Section: ' || role || ' > ' || turn || chr(10) || chr(10) || text, 300) AS embedding_text FROM conversations")
def chunk_representation(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.array("role", F.col("ordinal").cast("string"))
    return turn_chunks(spark, sf_dir).select("document_id", "ordinal", corpus.chunk_representation(F.col("title"), path, F.col("text"), 300).alias("embedding_text"))


@query("SELECT conv_id AS document_id, turn AS ordinal, last_value(CASE WHEN role = 'system' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS heading FROM conversations")
def forward_fill_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turn_chunks(spark, sf_dir).withColumn("heading", F.when(F.col("role") == "system", F.col("text")))
    return corpus.forward_fill(rows, "heading", "document_id", "ordinal").select("document_id", "ordinal", "heading")


@query("""WITH q AS (SELECT o_orderkey AS parent_id, CAST(o_orderkey * 10 + 1 AS BIGINT) AS accepted FROM orders),
a AS (SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS id, l_orderkey AS parent_id, CAST(l_quantity AS BIGINT) - 25 AS score FROM lineitem),
j AS (SELECT a.*, id = accepted AS accepted FROM a JOIN q USING (parent_id))
SELECT parent_id, id, score, accepted, row_number() OVER (PARTITION BY parent_id ORDER BY accepted DESC, score DESC, id) AS place FROM j WHERE accepted OR score > 0""")
def stack_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as questions, their lines as answers with quantity less 25 as score."""
    null = F.lit(None).cast("long")
    questions = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("question").alias("kind"), null.alias("parent_id"), (F.col("o_orderkey") * 10 + 1).alias("accepted_id"), null.alias("score"))
    answers = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.lit("answer").alias("kind"), F.col("l_orderkey").alias("parent_id"), null.alias("accepted_id"), (F.col("l_quantity").cast("long") - 25).alias("score"))
    return corpus.retain_answers(questions.unionByName(answers)).select("parent_id", "id", "score", "accepted", F.col("place").cast("long").alias("place"))


# comparison and integrity


_GENERATIONS = """o AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE doc_id % 7 <> 0),
n AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN sha256(text || ' revised') ELSE sha256(text) END AS h FROM documents WHERE doc_id % 11 <> 0),
p AS (SELECT coalesce(o.doc_id, n.doc_id) AS document_id, CASE WHEN o.doc_id IS NULL THEN 'added' WHEN n.doc_id IS NULL THEN 'deleted' WHEN o.h = n.h THEN 'unchanged' ELSE 'modified' END AS change FROM o FULL JOIN n ON o.doc_id = n.doc_id)"""


def _generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two generations: the old one lacks every seventh document, the new one every eleventh, and every fifth is revised."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), "text")
    old = docs.where("document_id % 7 <> 0").select("document_id", F.sha2("text", 256).alias("content_hash"))
    revised = F.when(F.col("document_id") % 5 == 0, F.concat("text", F.lit(" revised"))).otherwise(F.col("text"))
    new = docs.where("document_id % 11 <> 0").select("document_id", F.sha2(revised, 256).alias("content_hash"))
    return corpus.update_plan(old, new)


@query(f"WITH {_GENERATIONS} SELECT * FROM p")
def update_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _generations(spark, sf_dir)


@query(f"WITH {_GENERATIONS}, k AS (SELECT *, row_number() OVER (PARTITION BY change ORDER BY document_id) AS k FROM p) SELECT change, count(*) AS n, string_agg(CASE WHEN k <= 5 THEN document_id END, ',' ORDER BY document_id) AS samples FROM k GROUP BY change")
def update_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.update_summary(_generations(spark, sf_dir))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority = '1-URGENT')")
def orphan_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an urgent order."""
    some = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return corpus.orphans(table(spark, sf_dir, "customer"), some, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("SELECT count(*) AS broken FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def fk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.orphans(table(spark, sf_dir, "lineitem").select("l_orderkey"), table(spark, sf_dir, "orders"), "l_orderkey", "o_orderkey").agg(F.count(F.lit(1)).alias("broken"))


@query("SELECT count(*) AS n, count(DISTINCT doc_id) AS n_distinct, min(doc_id) AS least, max(doc_id) AS most, count(*) = count(DISTINCT doc_id) AND max(doc_id) - min(doc_id) + 1 = count(*) AS contiguous FROM documents")
def contiguity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.contiguity(table(spark, sf_dir, "documents"), "doc_id")


@query("""WITH o AS (SELECT DISTINCT page_id * 100 AS "offset" FROM pages) SELECT "offset", coalesce(lead("offset") OVER (ORDER BY "offset"), 10000000) AS "end" FROM o""")
def block_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.block_spans(table(spark, sf_dir, "pages").select((F.col("page_id") * 100).alias("offset")), 10_000_000)


# parsing and addresses


_BARE = "regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>', '', 'g')"
_HREF = f"list_transform(regexp_extract_all({_BARE}, '(?is)<(?:a|area)\\b[^>]*?\\bhref\\s*=\\s*[\"'']?([^\"''\\s>]+)', 1), lambda u: regexp_replace(u, '&amp;', '&', 'g'))"


@query(f"SELECT page_id, len(l) AS n_links, array_to_string(l, ' ') AS targets FROM (SELECT page_id, {_HREF} AS l FROM pages) WHERE len(l) > 0")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of the anchors of each page that has any, by a parser; comments and scripts hold none."""
    from quarry.sources.catalog import page_anchors

    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("url"), "html")
    links = page_anchors(pages).groupBy("url").agg(F.sort_array(F.collect_list(F.struct("place", "href"))).alias("l"))  # the links of one page
    return links.select(F.col("url").cast("long").alias("page_id"), F.size("l").cast("long").alias("n_links"), F.array_join(F.col("l.href"), " ").alias("targets"))


@query("""WITH p AS (SELECT page_id, lower(regexp_extract(url, '(?i)^(https?)://([^/?#]+)([^?#]*)', 1) || '://' || regexp_extract(url, '(?i)^(https?)://([^/?#]+)([^?#]*)', 2)) AS h,
regexp_replace(regexp_extract(url, '(?i)^(https?)://([^/?#]+)([^?#]*)', 3), '(?i)/index\\.html$', '/') AS path, url FROM pages)
SELECT page_id, CASE WHEN regexp_matches(url, '(?i)^(https?)://([^/?#]+)([^?#]*)') THEN h || CASE WHEN path = '' THEN '/' ELSE path END END AS canonical FROM p""")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.sources.files import canonical_url

    return table(spark, sf_dir, "pages").select("page_id", canonical_url(F.col("url")).alias("canonical"))


@query()
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of every page; a parser with state, which SQL cannot express."""
    from quarry.sources.importers import html_blocks as blocks

    ship(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", F.posexplode(blocks("html")).alias("block_index", "b"))
    return pages.select("page_id", "block_index", "b.kind", F.array_join("b.heading_path", " > ").alias("heading"), "b.text")


@query()
def chunk_blocks_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's paragraphs as chunks of bounded size."""
    from quarry.operators.chunking import chunk_column
    from quarry.sources.files import parsed_column

    docs = table(spark, sf_dir, "documents").select("doc_id", parsed_column(spark, F.lit("document.txt"), F.col("text")).alias("p")).select("doc_id", F.col("p.blocks").alias("blocks"))
    return chunk_column(docs).select("doc_id", "ordinal", "text", F.length("text").alias("character_count"))


@query("""WITH RECURSIVE d AS (SELECT doc_id // 1000 AS archive, doc_id, n_chars, row_number() OVER (PARTITION BY doc_id // 1000 ORDER BY doc_id) AS k FROM documents),
p AS (SELECT archive, doc_id, k, CAST(0 AS BIGINT) AS part, CAST(n_chars AS BIGINT) AS held, CAST(1 AS BIGINT) AS n FROM d WHERE k = 1
UNION ALL
SELECT d.archive, d.doc_id, d.k, CASE WHEN p.held + d.n_chars > 50000 OR p.n >= 128 THEN p.part + 1 ELSE p.part END,
  CASE WHEN p.held + d.n_chars > 50000 OR p.n >= 128 THEN d.n_chars ELSE p.held + d.n_chars END, CASE WHEN p.held + d.n_chars > 50000 OR p.n >= 128 THEN 1 ELSE p.n + 1 END
FROM p JOIN d ON d.archive = p.archive AND d.k = p.k + 1)
SELECT archive, doc_id, part FROM p""")
def part_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of a thousand documents each, in order, into parts bounded by characters and number: a running sum that
    starts anew, made for each archive."""
    import pandas as pd

    from quarry.operators.corpus import pack_parts

    ship(spark)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id")
        return group.assign(part=pack_parts(group["n_chars"].tolist(), 50_000, 128))[["archive", "doc_id", "part"]]

    docs = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 1000).alias("archive"), "doc_id", "n_chars")
    return docs.groupBy("archive").applyInPandas(run, "archive long, doc_id long, part long")


@query("""WITH f AS (SELECT CAST(doc_id AS VARCHAR) AS name, text FROM documents WHERE lang <> 'de'),
e AS (SELECT CAST(doc_id AS VARCHAR) AS name, CASE WHEN lang = 'fr' THEN sha1('other') ELSE sha1(text) END AS sha1 FROM documents WHERE lang <> 'es')
SELECT coalesce(f.name, e.name) AS name, CAST(strlen(f.text) AS BIGINT) AS bytes, coalesce(sha1(f.text), e.sha1) AS sha1,
CASE WHEN f.name IS NULL THEN 'missing' WHEN e.name IS NULL THEN 'unlisted' WHEN sha1(f.text) = e.sha1 THEN 'verified' ELSE 'differs' END AS state FROM f FULL JOIN e ON f.name = e.name""")
def checksum_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files against a list of hashes: languages are missing here or there, and one is listed wrongly."""
    from quarry.sources.catalog import checked_files

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("name"), "text", "lang")
    sha = F.sha1(F.when(F.col("lang") == "fr", "other").otherwise(F.col("text")).cast("binary"))
    files = docs.where("lang <> 'de'").select("name", F.col("text").alias("content"))
    return checked_files(files, docs.where("lang <> 'es'").select("name", sha.alias("sha1")))


@query("SELECT doc_id AS id, row_number() OVER (ORDER BY text, doc_id) - 1 AS vector_id FROM documents")
def dense_vector_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents numbered without gaps in the order of their texts, over range partitions."""
    from quarry.plans.vector_generations import dense_ids

    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.struct(F.col("text").cast("binary").alias("t"), "doc_id").alias("key"))
    return dense_ids(rows, "key").select("id", "vector_id")


@query("""SELECT l_partkey AS module, count(*) AS n, string_agg(l_orderkey || ':' || l_linenumber, ' ' ORDER BY l_orderkey, l_linenumber) AS places FROM lineitem GROUP BY l_partkey""")
def module_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as modules, orders as books: all places where a module stands."""
    found = corpus.occurrences_by_module(table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "module"), "module", ["l_orderkey", "l_linenumber"])
    place = lambda o: F.concat_ws(":", o["l_orderkey"].cast("string"), o["l_linenumber"].cast("string"))
    return found.select("module", "n", F.array_join(F.transform("occurrences", place), " ").alias("places"))


@query("""WITH p AS (SELECT CAST(conv_id AS VARCHAR) AS relative, length(trim(CASE WHEN role = 'user' THEN text ELSE '' END)) > 0 AS t, role = 'assistant' AS i FROM conversations),
c AS (SELECT relative, count(*) FILTER (t) AS text_pages, count(*) FILTER (NOT t AND i) AS image_pages, count(*) FILTER (NOT t AND NOT i) AS blank_pages FROM p GROUP BY relative)
SELECT *, CASE WHEN text_pages + image_pages > 0 THEN round(text_pages / (text_pages + image_pages), 9) ELSE 0 END AS ratio FROM c""")
def searchable_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as paged documents: what users say is text, what assistants say stands for scans."""
    from quarry.sources.paged import searchable

    said = F.when(F.col("role") == "user", F.col("text"))
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("relative"), F.col("turn").alias("page"), said.alias("text"), (F.col("role") == "assistant").alias("has_images"))
    return searchable(pages).withColumn("ratio", F.round("ratio", 9))


@query("""SELECT doc_id, source FROM documents WHERE doc_id > 40 ORDER BY doc_id LIMIT 25""")
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of 25 rows behind a key: the limit is what the operator is for."""
    return corpus.keyset_page(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", 40, 25)


@query("""SELECT event_type, CASE WHEN coalesce(json_extract_string(props, '$.k'), '') = '' THEN 'source_chunk' ELSE 'procedure_method' END AS evidence_kind, count(*) AS n FROM events GROUP BY ALL""")
def evidence_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kind of evidence that open JSON fields tell of, their member ``k`` taken for a procedure's method."""
    named = table(spark, sf_dir, "events").select("event_type", F.regexp_replace("props", '"k"', '"procedure_method"').alias("attributes"))
    return corpus.evidence_columns(named).groupBy("event_type", "evidence_kind").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extension: the batch form of the streaming aggregate."""
    from quarry.streaming.ingest import windowed_counts as counts

    return counts(table(spark, sf_dir, "events"))


@query("SELECT event_type, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, count(*) AS n FROM events GROUP BY ALL")
def attribute_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A member of an open JSON field as a column."""
    return table(spark, sf_dir, "events").groupBy("event_type", F.get_json_object("props", "$.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))
