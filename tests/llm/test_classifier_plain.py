"""The classifier's features, risk and scores against plain versions."""

import math
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from quarry.llm import quality_classifier as qc


def kind(c):
    if c > 127:
        return 9
    c = chr(c)
    if c.isalpha():
        return 0 if c.islower() else 1
    for k, signs in ((2, "0123456789"), (3, "\n"), (4, " \t\r\x0b\x0c\x1c\x1d\x1e\x1f"), (5, ".,;:'\"-"), (6, "!?"), (7, "()[]{}<>/\\|_=+")):
        if c in signs:
            return k
    return 8


def features(text):
    raw = (text or "").encode()
    words = raw.split()
    out = [0.0] * 1012
    if not words:
        return out
    kinds = [kind(b) for b in raw]
    for a, b, c in zip(kinds, kinds[1:], kinds[2:]):
        out[a * 100 + b * 10 + c] += 1
    if len(kinds) > 2:
        out[:1000] = [math.sqrt(x / (len(kinds) - 2)) for x in out[:1000]]
    share = lambda k: kinds.count(k) / len(kinds)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n = len(words)
    out[1000:] = [math.log1p(n) / 10, len(set(words)) / n, sum(map(len, words)) / n / 10, max(map(len, words)) / 100, len(set(lines)) / len(lines), math.log1p(len(lines)) / 10, *(share(k) for k in (1, 2, 6, 7, 8, 0))]
    return out


TEXTS = [None, "", "  ", "a", "Ab 1!\n\nAb 1!", "Zürich, 日本 (x) = [y]\tq\x1cz", "w " * 5000]


def test_features():
    for t in TEXTS:
        assert np.allclose(qc.features(t), features(t), atol=1e-6), repr(t)


def risk(w, p, u, prior):
    """Both parts of the risk for the sigmoid loss, row by row."""
    s = lambda x: 1 / (1 + math.exp(-float(x @ w)))
    gain = prior * sum(1 - s(x) for x in p) / len(p)
    rest = sum(s(x) for x in u) / len(u) - prior * sum(s(x) for x in p) / len(p)
    return gain, rest


def test_steps_follow_the_gradient_of_the_non_negative_risk():
    rng = np.random.default_rng(3)
    p, u = qc._with_one(rng.normal(0.5, 1, (40, 4))), qc._with_one(rng.normal(-0.5, 1, (60, 4)))
    for prior, w in ((0.3, rng.normal(0, 1, 5)), (0.9, rng.normal(0, 1, 5)), (0.9, np.array([3.0, 3, 3, 3, 1]))):
        gain, rest = risk(w, p, u, prior)
        target = (lambda v: sum(risk(v, p, u, prior))) if rest >= 0 else (lambda v: -risk(v, p, u, prior)[1])
        want = [(target(w + e) - target(w - e)) / 2e-5 for e in np.eye(5) * 1e-5]
        assert np.allclose(qc.risk_gradient(w, p, u, prior), want, atol=1e-6)


def test_scores_are_the_model_on_plain_features_whatever_the_order_of_rows(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = qc.train(docs, labels)
    again = qc.train(docs.repartition(5), labels.repartition(3))
    assert np.array_equal(model.weights, again.weights) and model.prior == again.prior
    got = {r["doc_id"]: r["score"] for r in qc.report(docs, labels).collect()}
    for r in docs.collect():
        x = (np.array(features(r["text"]), dtype=np.float32) - model.mean) / model.scale
        assert got[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-float(x @ model.weights + model.bias))), abs=1e-4)


def test_the_model_never_sees_held_out_labels(spark, sf):
    from pyspark.sql import functions as F

    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.withColumn("quality", F.when(qc.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    changed = docs.withColumns({"lang": F.lit("x"), "source": F.lit("y")})
    assert np.array_equal(qc.train(docs, labels).weights, qc.train(changed, turned).weights)
