"""What a task holds does not grow with its rows."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from quarry.operators import lexical, semantic


def test_vector_scores_are_made_in_slices():
    """A full Arrow batch against many queries: all its scores at once are 164 MB, and were held twice."""
    rng = np.random.default_rng(5)
    queries, rows = rng.standard_normal((2048, 8)), rng.standard_normal((10_000, 8))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(10_000)), pa.array(list(rows), pa.list_(pa.float64()))], names=["vec_id", "embedding"])
    shared = SimpleNamespace(value=(np.arange(2048), queries))
    try:
        run = semantic._best(shared, 3, 9)
    except TypeError:  # as it was
        run = semantic._best(shared, 3)
    tracemalloc.start()
    found = list(run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    got = {}
    for part in found:
        for q, v in zip(part["query_id"].to_pylist(), part["vec_id"].to_pylist(), strict=True):
            got.setdefault(q, []).append(v)
    scores = queries[::97] @ rows.T
    assert [set(got[q]) for q in range(0, 2048, 97)] == [set(x) for x in np.argsort(-scores, axis=1)[:, :3].tolist()]


def test_equal_vectors_leave_a_task_as_often_as_asked(spark):
    same = spark.range(0, 3000, 1, 1).selectExpr("id AS vec_id", "array(1.0D, 2.0D) AS embedding")
    asked = same.where("vec_id = 7").selectExpr("vec_id AS query_id", "embedding")
    got = semantic.top_k(same, asked, 4)
    assert [(r["vec_id"], r["rank"]) for r in got.orderBy("rank").collect()] == [(0, 1), (1, 2), (2, 3), (3, 4)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array([[1.0, 2.0]] * 3000)], names=["vec_id", "embedding"])
    assert sum(b.num_rows for b in semantic._best(SimpleNamespace(value=(np.array([7]), np.array([[1.0, 2.0]]))), 4, 9)(iter([batch, batch]))) == 4


def test_scores_that_round_alike_rank_by_id(spark):
    """The lesser score of the lesser id is 3e-10 below the other: alike at nine places."""
    rows = spark.createDataFrame([(2, [1.0, 0.0]), (1, [1.0, 2.5e-5])], "vec_id long, embedding array<double>").coalesce(1)
    asked = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<double>")
    assert [r["vec_id"] for r in semantic.top_k(rows, asked, 1).collect()] == [1]


def test_pages_are_parsed_a_few_at_a_time():
    """Of 2000 pages of one batch, at most 64 are held as blocks."""
    import pandas as pd

    from quarry.sources import importers

    pages = pd.Series(["<h1>T</h1>" + "<p>some words</p>" * 50] * 2000)
    tracemalloc.start()
    made = importers.html_blocks.func(iter([pages]) if importers.html_blocks.evalType != 200 else pages)
    n = sum(len(part) for part in made) if importers.html_blocks.evalType != 200 else len(made)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2000 and peak < 20e6


CHUNKS = [(i, f"w{i % 3} w{i % 5} common") for i in range(60)]


@pytest.mark.parametrize("mode", ["or", "and"])
def test_parts_follow_pairs(spark, monkeypatch, mode):
    """The sums of queries and rows, not the bytes of postings, decide into how many parts rows are dealt."""
    chunks = spark.createDataFrame(CHUNKS, "row_id long, text string")
    terms = spark.createDataFrame([(q, mode, p, t) for q in range(8) for p, t in enumerate(("common", f"w{q % 5}"))], "query_id int, mode string, pos int, term string")
    index = lexical.build_index(chunks, {"text": "text"}, terms, positions=False)
    rows = lambda: sorted((r["query_id"], r["row_id"], round(r["raw_score"], 9)) for r in lexical.match_terms(index, terms).collect())
    want = rows()
    monkeypatch.setattr(lexical, "MOST_PAIRS", 8, raising=False)
    found = lexical.match_terms(index, terms)
    assert rows() == want and len(want) > 60
    found.count()
    assert found.rdd.getNumPartitions() >= 12
