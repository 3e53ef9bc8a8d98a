"""Shared, null and string ids, very long texts and columns that bear the operators' own names."""

import pytest

from quarry.llm import exact_dedup, quality_rules, secret_scan, simhash_dedup

A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
B = "red orange yellow green blue indigo violet black white grey brown pink purple cyan magenta"
LONG = " ".join(f"word{i}" for i in range(200_000))
NAMES = ["_hash", "_row", "_counts", "_spans", "failed_rule", "fp", "root", "row", "n_words", "a.b"]
TEXTS = [(1, A), (1, B), (0, B), (None, A), (None, LONG), (7, LONG), (7, LONG), (8, None), (None, ""), (9, "x")]


def frame(spark, id_type, texts=TEXTS):
    ids = (lambda i: i) if id_type == "long" else (lambda i: None if i is None else f"id-{i}")
    rows = [(ids(i), t, *(f"{n}{k}" for n in NAMES)) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id {id_type}, text string, " + ", ".join(f"`{n}` string" for n in NAMES)).repartition(3)


@pytest.mark.parametrize("id_type", ["long", "string"])
@pytest.mark.parametrize("drop", [exact_dedup.drop_copies, simhash_dedup.drop_near_copies])
def test_one_row_of_each_text_stays_as_it_was(spark, drop, id_type):
    docs = frame(spark, id_type)
    before = {r["_hash"]: tuple(r) for r in docs.collect()}
    kept = drop(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert all(tuple(r) == before[r["_hash"]] for r in got)
    name = (lambda i: i) if id_type == "long" else (lambda i: None if i is None else f"id-{i}")
    want = [(name(1), A), (name(0), B), (name(7), LONG), (name(8), None), (name(9), "x")]
    assert sorted(((r["doc_id"], r["text"] or "") for r in got), key=repr) == sorted(((i, t or "") for i, t in want), key=repr)


@pytest.mark.parametrize("id_type", ["long", "string"])
def test_marks_of_odd_ids(spark, id_type):
    docs = frame(spark, id_type)
    found = exact_dedup.duplicates(docs).collect()
    assert len(found) == len(TEXTS) and sum(r["kept"] for r in found) == 5
    near = simhash_dedup.near_duplicates(docs).collect()
    assert len(near) == len(TEXTS)
    assert {r["fingerprint"]: r["component_id"] for r in near}["0" * 16] == (8 if id_type == "long" else "id-8")


def test_rules_and_secrets_leave_other_columns_alone(spark):
    docs = frame(spark, "long")
    assert quality_rules.measure(docs).select("_counts").collect() == docs.select("_counts").collect()
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns
    assert {r["_hash"] for r in kept.collect()} == {f"_hash{k}" for k in range(7)}
    clean = secret_scan.redact(docs)
    assert clean.columns == docs.columns and sorted(map(repr, clean.collect())) == sorted(map(repr, docs.collect()))
