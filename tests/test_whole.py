"""Queries that read whole rows and every row that is due."""

import re

from quarry.functions import ranking
from quarry.functions.text import technical_plain
from quarry.operators import lexical
from quarry.plans import queries
from quarry.plans.search import search_documents
from quarry.session import Collection, Corpus


def tables(spark, tmp_path, **rows):
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


DOCS = "doc_id long, text string, lang string, source string"


def test_late_terms_of_a_passage_are_searched(spark, tmp_path):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, "the kappa alone", "en", "web"), (2, f"before {passage} after", "en", "web"), (3, "alpha beta gamma delta epsilon zeta eta theta", "en", "web"), (4, "nothing", "en", "web")]
    at = tables(spark, tmp_path, documents=(docs, DOCS), benchmark=([(7, passage)], "item_id long, text string"))
    for f in (queries.bm25_or, queries.bm25_four_fields, queries.evidence_dedup):
        got = f(spark, at).collect()
        assert {int(r["row_id"] if "row_id" in r else r["document_id"]) for r in got} == {1, 2, 3}
    for f in (queries.bm25_and, queries.bm25_phrase):
        assert [r["row_id"] for r in f(spark, at).collect()] == [2]
    whole = [r for r in queries.query_relaxation(spark, at).collect() if passage in r["matched_variants"].split("|")]
    assert [r["document_id"] for r in whole] == [2]


def test_every_fiftieth_vector_is_a_query(spark, tmp_path):
    rows = [(i, [float(i % 7 + 1), float(i % 11)], i % 3) for i in range(320)]
    at = tables(spark, tmp_path, embeddings=(rows, "vec_id long, embedding array<float>, label int"))
    due = set(range(0, 320, 50))
    assert {r["query_id"] for r in queries.vector_topk(spark, at).collect()} == due
    assert {r["query_id"] for r in queries.vector_best_per_group(spark, at).collect()} == due


def test_technical_names_of_whole_documents(spark, sf, tmp_path):
    texts = ["one two three four five six seven std::vector and foo_bar of C++", "no such name here", "", None, "İ ß a.NET .NET x_y::z_w C#"]
    at = tables(spark, tmp_path, documents=([(i, t, "en", "web") for i, t in enumerate(texts)], DOCS))
    for path in (at, sf):
        want = {r["doc_id"]: technical_plain(r["text"] or "") for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
        assert {r["doc_id"]: r["technical"] for r in queries.technical_alias(spark, path).collect()} == want


def test_late_tokens_change_the_hash(spark, tmp_path):
    words = " ".join(f"w{i}" for i in range(30))
    at = tables(spark, tmp_path, documents=([(1, f"{words} x", "en", "web"), (2, f"{words} y", "en", "web")], DOCS))
    assert len({r["tokens_sha256"] for r in queries.tokenize_terms(spark, at).collect()}) == 2


def routed(query):
    every = re.findall(ranking.TOKEN, query.lower())
    kept = [t for t in every if t not in ranking.STOP_WORDS] or every
    found = [m[0] for m in re.finditer(ranking.IDENTIFIER, query)]
    if '"' in query:
        return "bm25", "an exact or phrase match is asked for"
    if found and len(every) <= 8 and len({x.lower() for x in found}) / max(1, len(every)) >= 0.4:
        return "bm25", "technical identifiers dominate"
    if every and every[0] not in ranking.QUESTION_WORDS and len(every) <= 7 and len(kept) <= 5:
        return "bm25", "a terse technical phrase"
    return "hybrid", "concepts in natural language gain from both indexes"


def test_routes_of_whole_texts(spark, sf, tmp_path):
    asked = ["use foo_bar", "HTTP 404", "why is the sky blue over the wide sea", "wild flowers", "", None, 'say "this"', "what is std::vector", "what does the .NET a.b do"]
    schema = "item_id long, text string"
    at = tables(spark, tmp_path, benchmark=(list(enumerate(asked)), schema), pages=([(1, "http://a.example/RFC/793")], "page_id long, url string"))
    for path in (at, sf):
        texts = {("benchmark", r["item_id"]): r["text"] for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()}
        texts |= {("pages", r["page_id"]): r["url"] for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
        got = {(r["kind"], r["item_id"]): (r["retrieval"], r["reason"]) for r in queries.route_query(spark, path).collect()}
        assert got == {k: routed(v or "") for k, v in texts.items()}
        assert "technical identifiers dominate" in {why for _, why in got.values()}


CHUNKS = "row_id long, document_id string, title string, heading string, text string, ordinal int, front_matter boolean"


def test_a_document_of_many_chunks_leaves_room(spark):
    rows = [(i, "big", "", "", "alpha beta", i, False) for i in range(1200)] + [(1200, "small", "", "", "alpha beta and many other words besides", 0, False)]
    chunks = spark.createDataFrame(rows, CHUNKS).cache()
    index = lexical.build_index(chunks, {"text": "text"}).cache()
    vectors = spark.createDataFrame([(r[0], [1.0, 0.001 if r[1] == "big" else 0.5]) for r in rows], "vec_id long, embedding array<double>").cache()
    held = Collection(spark, [Corpus("c", chunks, index, vectors)], lambda texts: [[1.0, 0.0] for _ in texts])
    assert {r["document_id"] for r in held._semantic(held.corpora["c"], "alpha", 50).collect()} == {"big", "small"}
    few = chunks.where("row_id < 120 or row_id = 1200")
    index = lexical.build_index(few, {"text": "text"})
    asked = spark.createDataFrame([("q", ["alpha", "beta"])], "query_id string, terms array<string>")
    assert {r["document_id"] for r in search_documents(index, asked, few).collect()} == {"big", "small"}
    most = chunks.where("row_id < 390 or row_id = 1200")
    held = Collection(spark, [Corpus("c", most, lexical.build_index(most, {"text": "text"}))])
    assert {r["document_id"] for r in held.search("alpha beta").collect()} == {"big", "small"}
