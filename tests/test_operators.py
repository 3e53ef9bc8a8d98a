import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import ranking, vectors
from quarry.operators import citations, corpus, evaluation, fusion, semantic


def test_metrics_by_hand():
    m = evaluation.metrics_plain([["primary", "relevant-a"], ["relevant-b"]], {"relevant-a": 3, "relevant-b": 1})
    assert m["success@1"] == 1 and m["recall@5"] == 1 and m["mrr@10"] == 1 and m["ndcg@10"] == pytest.approx(1)
    m = evaluation.metrics_plain([["a"], ["b"], ["c"]], {"b": 3, "c": 1, "d": 2})
    assert m["success@1"] == 0 and m["mrr@10"] == 0.5 and m["recall@5"] == pytest.approx(2 / 3)
    assert m["ndcg@10"] == pytest.approx((7 / math.log2(3) + 1 / 2) / (7 + 3 / math.log2(3) + 1 / 2))


def test_batch_metrics_equal_plain_ones(spark):
    rng = np.random.default_rng(0)
    ranked, judged = [], []
    for q in range(20):
        ids = rng.permutation(30)
        ranked += [(q, int(d), i + 1) for i, d in enumerate(ids)]
        judged += [(q, int(d), int(g)) for d, g in zip(rng.permutation(40)[:6], rng.integers(1, 4, 6), strict=True)]
    got = evaluation.case_metrics(spark.createDataFrame(ranked, "query_id int, document_id int, rank int"), spark.createDataFrame(judged, "query_id int, document_id int, grade int")).collect()
    for r in got:
        q = r["query_id"]
        want = evaluation.metrics_plain([[d] for a, d, _ in ranked if a == q], {d: g for a, d, g in judged if a == q})
        for name, value in want.items():
            assert r[name.replace("@", "_")] == pytest.approx(value)


def test_nearest_rank(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (100.0,), (None,)], "v double")
    assert tuple(evaluation.nearest_rank(df, "v", (50, 95, 99)).first()) == (2.0, 100.0, 100.0)


def test_suites():
    good = {"schema_version": 2, "cases": [{"id": "a", "query": "q", "relevance": {"d": 2}}]}
    assert evaluation.validate_suite(good) == []
    assert evaluation.validate_suite({"cases": [{"query": "q", "expected_titles": ["T"]}]}) == []
    bad = {"schema_version": 2, "cases": [{"id": "a", "query": "q", "relevance": {"d": True}}, {"id": "a", "query": "", "relevance": {}}]}
    assert len(evaluation.validate_suite(bad)) == 4


@pytest.mark.parametrize(
    ("query", "corpus_id", "hybrid", "mode", "want"),
    [
        ("how do I rotate keys safely in production systems", "docs", True, "and", "hybrid"),
        ("how do I rotate keys safely", "docs", False, "and", "bm25"),
        ("anything about ports and names at all please", "iana-protocol-registries", True, "and", "bm25"),
        ("how does it work in practice over there", "docs", True, "phrase", "bm25"),
        ('what does "exact words" mean for them all', "docs", True, "and", "bm25"),
        ("MAX_PATH error_code", "docs", True, "and", "bm25"),
        ("vacuum database", "docs", True, "and", "bm25"),
        ("what makes a database slow", "docs", True, "and", "hybrid"),
    ],
)
def test_routes(spark, query, corpus_id, hybrid, mode, want):
    retrieval, reason = ranking.route(F.lit(query), F.lit(corpus_id), F.lit(hybrid), F.lit(mode))
    row = spark.range(1).select(retrieval.alias("r"), reason.alias("why")).first()
    assert row["r"] == want and row["why"]


def test_rerank_prefers_identifiers_and_titles(spark):
    rows = [("q", "a", 1, 1 / 61, "Other", "", "nothing", False, False, "docs"), ("q", "b", 2, 1 / 62, "Guide", "", "sets MAX_PATH here", False, False, "docs"), ("q", "c", 3, 1 / 63, "Guide", "", "text", False, True, "docs")]
    df = spark.createDataFrame(rows, "query_id string, document_id string, position int, base_score double, title string, heading string, text string, dual boolean, exact_title boolean, corpus string")
    got = fusion.rerank(df, F.lit("MAX_PATH limit")).orderBy("rerank_position").collect()
    assert [r["document_id"] for r in got] == ["c", "b", "a"]


def test_evidence_dedup(spark):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [("q", 1, "a", "x", words), ("q", 2, "b", "x", "same content id"), ("q", 3, "c", "y", words + " extra"), ("q", 4, "d", "z", "short one"), ("q", 5, "e", "v", "short one")]
    got = {r["document_id"]: r for r in fusion.deduplicate_ranked(spark.createDataFrame(rows, "query_id string, position int, document_id string, content_id string, text string")).collect()}
    assert [d for d in "abcde" if got[d]["kept"]] == ["a", "d", "e"]
    assert got["a"]["alternates"] == ["b", "c"] and got["b"]["reason"] == "content_id" and got["c"]["reason"].startswith("token_jaccard:0.96")
    with pytest.raises(ValueError):
        fusion.deduplicate([], 0.4)


def test_fusion(spark):
    a = spark.createDataFrame([("q", 1, 1), ("q", 2, 2)], "query_id string, document_id int, rank int")
    b = spark.createDataFrame([("q", 2, 1), ("q", 3, 2)], "query_id string, document_id int, rank int")
    got = fusion.reciprocal_rank_fusion({"lexical": (a, 1.0), "semantic": (b, 1.0)}).orderBy("position").collect()
    assert [r["document_id"] for r in got] == [2, 1, 3]
    assert got[0]["fusion_score"] == pytest.approx(1 / 61 + 1 / 62) and got[1]["semantic_rank"] is None


def test_vectors(spark):
    df = spark.createDataFrame([(0, [3.0, 4.0]), (1, [0.0, 0.0]), (2, [float("nan"), 1.0]), (3, None), (4, [1.0, 0.0]), (5, [4.0, 3.0])], "vec_id long, embedding array<float>")
    unit = {r["vec_id"]: r["u"] for r in df.select("vec_id", vectors.normalize(F.col("embedding")).alias("u")).collect()}
    assert unit[0] == pytest.approx([0.6, 0.8]) and unit[1] is None and unit[2] is None and unit[3] is None
    queries = spark.createDataFrame([(7, [1.0, 0.0])], "query_id long, embedding array<float>")
    got = semantic.top_k(df, queries, 2).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [4, 5] and got[1]["score"] == pytest.approx(0.8)
    assert semantic.top_k(df.limit(0), queries, 2).count() == 0 and semantic.top_k(df, queries.limit(0), 2).count() == 0
    with pytest.raises(ValueError):
        semantic.top_k(df, queries, 0)
    texts = spark.createDataFrame([(1, "Apollo rocket"), (2, "bread recipe")], "i int, text string")
    provider = semantic.keyword_provider([["rocket"], ["bread"]])
    embedded = {r["i"]: r["embedding"] for r in semantic.embed(texts, provider).collect()}
    assert embedded[1][0] > 0.99 and embedded[2][1] > 0.99


def test_update_plan(spark):
    old = spark.createDataFrame([(100, "Alpha"), (102, "Beta"), (104, "Gone")], "document_id int, content_hash string")
    new = spark.createDataFrame([(100, "Alpha"), (102, "Beta 2"), (103, "New")], "document_id int, content_hash string")
    plan = corpus.update_plan(old, new)
    assert {r["document_id"]: r["change"] for r in plan.collect()} == {100: "unchanged", 102: "modified", 103: "added", 104: "deleted"}
    assert {r["change"]: (r["n"], r["samples"]) for r in corpus.update_summary(plan).collect()}["added"] == (1, "103")


def test_context_at_a_start_is_as_long(spark):
    chunks = spark.createDataFrame([("d", i, f"t{i}") for i in range(6)], "document_id string, ordinal int, text string")
    got = lambda at: [r["ordinal"] for r in corpus.context(chunks, chunks.where(F.col("ordinal") == at), 2, 1).orderBy("ordinal").collect()]
    assert got(3) == [1, 2, 3, 4] and got(0) == [0, 1, 2, 3]
    page = corpus.document_page(chunks, "d", 2, 3).collect()
    assert [r["ordinal"] for r in page] == [2, 3, 4] and page[0]["has_more"] and page[0]["total"] == 6
    with pytest.raises(ValueError):
        corpus.document_page(chunks, "d", 0, 500)


def test_answers_that_stay(spark):
    rows = [(1, "question", None, 11, 5), (10, "answer", 1, None, 4), (11, "answer", 1, None, 0), (12, "answer", 1, None, -1), (13, "answer", 9, None, 3)]
    got = corpus.retain_answers(spark.createDataFrame(rows, "id long, kind string, parent_id long, accepted_id long, score long")).orderBy("place").collect()
    assert [r["id"] for r in got] == [11, 10]


def test_samples_and_parts():
    assert corpus.even_samples(10, 4) == [0, 3, 6, 9] and corpus.even_samples(3, 9) == [0, 1, 2] and corpus.even_samples(6, 3) == [0, 2, 5]
    assert corpus.pack_parts([5, 5, 5, 20, 1], 10, 2) == [0, 0, 1, 2, 3]


def test_citations(spark):
    row = [("wikipedia-en", "T", ["a", "b"], "2020", "http://x", "v1"), ("docs", "T[1]", [], "2020", None, "v1")]
    df = spark.createDataFrame(row, "c string, t string, h array<string>, ts string, u string, v string")
    got = [r[0] for r in df.select(citations.citation(*(F.col(x) for x in ("c", "t", "h", "ts", "u", "v")))).collect()]
    assert got == ["Wikipedia — T § a > b (2020) http://x", "docs — T[1] (v1)"]
    rows = spark.createDataFrame([("q", 3, "B [x]", "http://b"), ("q", 1, "A", None), ("q", 5, "B [x]", "http://b")], "query_id string, position int, citation string, url string")
    assert [r["markdown"] for r in citations.numbered(rows).orderBy("position").collect()] == ["[S1] A", "[S2] B \\[x\\] <http://b>"]


def test_reuse_and_verification(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, fingerprint string")
    old = spark.createDataFrame([(1, "a", 5), (2, "x", 6), (9, "c", 8), (8, "c", 7)], "id int, fingerprint string, vector_id int")
    assert {r["id"]: r["vector_id"] for r in semantic.reuse_plan(new, old).collect()} == {1: 5, 2: None, 3: None}
    assert {r["id"]: r["vector_id"] for r in semantic.reuse_plan(new, old, by_document=False).collect()} == {1: 5, 2: None, 3: 7}
    bad = spark.createDataFrame([(0, [1.0]), (2, [0.0])], "vector_id int, embedding array<float>")
    row = semantic.verify_vectors(bad, 1).first()
    assert not row["contiguous"] and row["unusable"] == 1


def test_publication(spark, tmp_path):
    from quarry.plans import publish

    docs = spark.createDataFrame([("d1",)], "document_id string")
    chunks = spark.createDataFrame([("c1", "d1", "text", 4)], "chunk_instance_id string, document_id string, text string, character_count int")
    root = f"file://{tmp_path}/corpus"
    first = publish.publish(root, {"documents": docs, "chunks": chunks}, {"v": 1}, publish.check_corpus)
    with pytest.raises(ValueError):
        publish.publish(root, {"documents": docs.limit(0), "chunks": chunks}, {"v": 2}, publish.check_corpus)
    known, read = publish.current(spark, root)
    assert known["generation"] == first and read("chunks").count() == 1 and known["meta"]["rows"] == {"documents": 1, "chunks": 1}
    second = publish.publish(root, {"documents": docs, "chunks": chunks}, {"v": 3}, keep=1)
    assert publish.current(spark, root)[0]["generations"] == [second]
    assert json.loads(publish.canonical({"b": 1, "a": "é"})) == {"a": "é", "b": 1}


def test_collection(spark):
    from quarry.operators import lexical
    from quarry.session import Collection, Corpus

    schema = "row_id long, document_id string, title string, heading string, text string, ordinal int, front_matter boolean"
    a = spark.createDataFrame([(1, "a1", "Rockets", "", "Apollo rocket engines burn fuel", 0, False), (2, "a1", "Rockets", "", "They fly far", 1, False)], schema)
    b = spark.createDataFrame([(1, "b1", "Baking", "", "Bread rises with yeast and a rocket salad", 0, False)], schema)
    provider = semantic.keyword_provider([["rocket", "fly"], ["bread", "yeast"]])
    vec = semantic.embed(a, provider).select(F.col("row_id").alias("vec_id"), "embedding")
    made = Collection(spark, [Corpus("space", a, lexical.build_index(a), vec, {"LM": "rocket"}, "orbit|rocket"), Corpus("food", b, lexical.build_index(b))], provider)
    assert made.select("orbit")[1] == "pattern" and made.select("salt")[1] == "all"
    got = made.search("LM", names=["space", "food"]).collect()
    assert got[0]["document_id"] == "a1"
    assert [r["document_id"] for r in made.search("rocket", names=["space", "food"]).collect()] == ["a1", "b1"]
    assert made.search("what will fly far", retrieval="hybrid", names=["space"]).first()["document_id"] == "a1"
    assert made.document("space", "a1").count() == 2 and made.context("space", 2, 1, 0).count() == 2
    assert made.status().count() == 2
    with pytest.raises(KeyError):
        made.document("space", "zz")
    with pytest.raises(KeyError):
        made.search("x", names=["nowhere"])
    with pytest.raises(ValueError):
        made.search(" ")


def test_incremental_ingestion(spark, tmp_path):
    from quarry.streaming.ingest import ingest_new_files

    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text('{"document_id":"a","n":1}\n{"document_id":"a","n":1}\n')
    args = (spark, str(source), "document_id string, n int", str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    ingest_new_files(*args)
    (source / "2.json").write_text('{"document_id":"b","n":2}\n')
    ingest_new_files(*args)
    assert ingest_new_files(*args) == 0
    assert sorted(r["document_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
