import sqlite3

import pytest

from quarry.functions.text import alias, technical_plain, tokens_plain
from quarry.operators import lexical
from quarry.plans.search import search_documents


def test_planned_terms():
    assert lexical.plan_query("C# .NET 8").terms == ("csharp", "dotnet", "8")
    assert lexical.plan_query("What was the Apollo Guidance Computer?").terms == ("apollo", "guidance", "computer")
    assert lexical.plan_query("what was the apollo", "phrase").terms == ("what", "was", "the", "apollo")
    assert lexical.plan_query("what is the").terms == ("what", "is", "the")
    assert lexical.plan_query("std::vector").terms[0] == alias("scope", "std::vector")
    assert lexical.plan_query("foo_bar").terms == (alias("ident", "foo_bar"),)
    with pytest.raises(ValueError):
        lexical.plan_query("!!!")
    with pytest.raises(ValueError):
        lexical.plan_query("x", "near")


def test_technical_text_has_all_words_or_none():
    assert technical_plain("plain words") == ""
    assert technical_plain("Use C++ here") == "use cpp here"
    assert technical_plain("c+++ x.net ##c#") == ""


CHUNKS = [
    (1, 1, "Apollo Guidance Computer", "", "The computer was built for Apollo by MIT.", 0, False),
    (2, 1, "Apollo Guidance Computer", "Design", "Core rope memory; naïve Ünïcode words.", 1, False),
    (3, 2, "IBM", "", "IBM built the guidance computer of the Saturn rocket. Apollo flew.", 0, False),
    (4, 3, "Cover", "", "identical passage of text", 0, True),
    (5, 4, "Chapter", "", "identical passage of text", 0, False),
    (6, 5, "Vectors in C++", "std::vector", "Use std::vector and foo_bar in C++, C# or .NET code code code.", 0, False),
]


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame(CHUNKS, "row_id long, document_id long, title string, heading string, text string, ordinal int, front_matter boolean").cache()


@pytest.fixture(scope="module")
def index(chunks):
    return lexical.build_index(chunks).cache()


@pytest.fixture(scope="module")
def fts():
    con = sqlite3.connect(":memory:")
    con.execute("create virtual table t using fts5(title, heading, text, technical, tokenize='unicode61 remove_diacritics 2')")
    for row_id, _, title, heading, text, *_ in CHUNKS:
        con.execute("insert into t(rowid, title, heading, text, technical) values (?, ?, ?, ?, ?)", (row_id, title, heading, text, technical_plain(f"{title} {heading} {text}")))
    return con


@pytest.mark.parametrize(
    ("query", "mode"),
    [("apollo computer", "and"), ("apollo computer computer", "or"), ("guidance computer", "phrase"), ("naive unicode", "and"), ("C++", "or"), ("std::vector foo_bar", "and"), ("code code", "phrase"), ("C# memory rocket", "or")],
)
def test_scores_equal_sqlite(spark, index, fts, query, mode):
    plan = lexical.plan_query(query, mode)
    match = '"' + " ".join(plan.terms) + '"' if mode == "phrase" else (" AND " if mode == "and" else " OR ").join(f'"{t}"' for t in plan.terms)
    want = fts.execute("select rowid, bm25(t, 5.0, 2.0, 1.0, 2.0) from t where t match ?", (match,)).fetchall()
    got = lexical.search(index, lexical.plan_queries(spark, [("q", query, mode)]), 50).collect()
    assert want
    assert sorted((r["row_id"], round(r["raw_score"], 9)) for r in got) == sorted((i, round(s, 9)) for i, s in want)


def test_front_matter_ranks_last(spark, index, chunks):
    got = lexical.search(index, lexical.plan_queries(spark, [("q", "identical passage", "and")]), 5, chunks=chunks).orderBy("rank").collect()
    assert [r["row_id"] for r in got] == [5, 4]


def test_exact_title_comes_first_once(spark, index, chunks):
    got = lexical.search(index, lexical.plan_queries(spark, [("q", "ibm", "and"), ("p", "the apollo guidance computer", "and")]), 5, chunks=chunks).orderBy("query_id", "rank").collect()
    by = {q: [(r["document_id"], r["reason"]) for r in got if r["query_id"] == q] for q in "qp"}
    assert by["q"] == [(2, "exact_title")]
    assert by["p"][0] == (1, "exact_title") and [d for d, _ in by["p"]].count(1) == 1


def test_relaxation_recovers(spark, index, chunks):
    asked = spark.createDataFrame([("q", ["apollo", "guidance", "computer", "houston"]), ("r", ["apollo", "computer"])], "query_id string, terms array<string>")
    got = search_documents(index, asked, chunks, 5).orderBy("query_id", "position").collect()
    q = [r for r in got if r["query_id"] == "q"]
    assert q[0]["document_id"] == 1 and q[0]["relaxed"] and q[0]["fusion_score"] > 1
    assert all(not r["relaxed"] for r in got if r["query_id"] == "r")


def test_tokens_agree_with_sqlite(spark, fts):
    from pyspark.sql import functions as F

    from quarry.functions.text import tokens

    texts = ["naïve Ünïcode", "foo_bar::baz", "straße x² ½ ①", "don't 日本語 Ǆ é"]
    got = [r["t"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string").orderBy("i").select(tokens(F.col("s")).alias("t")).collect()]
    assert got[0] == ["naive", "unicode"] and got[1] == ["foo", "bar", "baz"]
    assert got[2] == ["straße", "x²", "½", "①"] and got[3][:3] == ["don", "t", "日本語"]
    assert [tokens_plain(t) for t in texts[:3]] == got[:3]
