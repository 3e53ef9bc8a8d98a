"""A quality classifier learnt from trusted positives and unlabelled text.

Positive-unlabelled learning minimises the non-negative unbiased risk: with the class prior p, positives P and
unlabelled text U, the risk is ``p * E_P[l(g)] + max(0, E_U[l(-g)] - p * E_P[l(-g)])`` for the sigmoid loss l; while
the second part is negative, the step goes against it, which keeps the model from fitting the unlabelled rows. The
prior is estimated first: a plain classifier of P against U orders held-back rows of both, and the smallest ratio of
U's share to P's share above a score bounds the share of positives in U.

Features come from the text alone: shares of three successive character classes, and a few counts of words, lines
and characters. The model is linear in them. It is fitted on the driver on at most ``sample_rows`` positives and as
many unlabelled rows, taken by a hash of doc_id; neither sample has rows of the held-out part. All rows are scored.
The sample is put in one order before it is fitted, so that the model does not depend on how rows were dealt.

Cases: a null text counts as empty and is scored; a null doc_id is never held out; labels that are null are ignored;
without positives, or without unlabelled rows, every score is one half; repeated rows are scored each, and of
rows that share a sampled doc_id the first text in code-point order is fitted; texts are read whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.runtime import ship

SAMPLE_ROWS = 8_000
CLASSES = 10
DENSE = 12


def _class_table() -> np.ndarray:
    table = np.full(256, 9, dtype=np.int64)  # bytes of letters beyond ASCII
    for b in range(128):
        c = chr(b)
        table[b] = 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c == "\n" else 4 if c.isspace() else 5 if c in ".,;:'\"-" else 6 if c in "!?" else 7 if c in "()[]{}<>/\\|_=+" else 8
    return table


_TABLE = _class_table()


def features(text: str | None) -> np.ndarray:
    """Square roots of the shares of class triples, then the counts, all in the order of one."""
    out = np.zeros(CLASSES**3 + DENSE, dtype=np.float32)
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return out
    of = _TABLE[np.frombuffer(raw, dtype=np.uint8)]
    if len(of) > 2:
        triples = np.bincount((of[:-2] * CLASSES + of[1:-1]) * CLASSES + of[2:], minlength=CLASSES**3)
        out[: CLASSES**3] = np.sqrt(triples / (len(of) - 2))
    shares = np.bincount(of, minlength=CLASSES) / len(of)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n = len(words)
    out[CLASSES**3 :] = [
        math.log1p(n) / 10, len(set(words)) / n, sum(map(len, words)) / n / 10, max(map(len, words)) / 100, len(set(lines)) / len(lines), math.log1p(len(lines)) / 10,
        shares[1], shares[2], shares[6], shares[7], shares[8], shares[0],
    ]
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(((x - self.mean) / self.scale) @ self.weights + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Adam:
    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, w: np.ndarray, g: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.001 * (g * g - self.v)
        w -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def _batches(p: np.ndarray, u: np.ndarray, epochs: int, size: int, rng) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _ in range(epochs):
        a, b = rng.permutation(len(p)), rng.permutation(len(u))
        for k in range(max(1, max(len(p), len(u)) // size)):
            yield p[np.take(a, range(k * size, (k + 1) * size), mode="wrap")], u[np.take(b, range(k * size, (k + 1) * size), mode="wrap")]


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])


def estimate_prior(p: np.ndarray, u: np.ndarray, seed: int = 1) -> float:
    """The share of positives in ``u``; rows are standardised features."""
    rng = np.random.default_rng(seed)
    p, u = _with_one(p[rng.permutation(len(p))]), _with_one(u[rng.permutation(len(u))])
    fit_p, fit_u, p, u = p[: len(p) // 2], u[: len(u) // 2], p[len(p) // 2 :], u[len(u) // 2 :]
    if min(len(fit_p), len(fit_u), len(p), len(u)) == 0:
        return 0.5
    w, adam = np.zeros(p.shape[1]), _Adam(p.shape[1], 0.003)
    for a, b in _batches(fit_p, fit_u, 15, 256, rng):
        g = (a.T @ (_sigmoid(a @ w) - 1)) / len(a) + (b.T @ _sigmoid(b @ w)) / len(b) + 1e-3 * w
        adam.step(w, g)
    sp, su = np.sort(p @ w), np.sort(u @ w)
    cuts = np.quantile(sp, np.linspace(0, 0.7, 71))
    above_p, above_u = 1 - np.searchsorted(sp, cuts) / len(sp), 1 - np.searchsorted(su, cuts) / len(su)
    doubt = np.sqrt(above_u * (1 - above_u) / len(su)) / above_p
    return float(np.clip((above_u / above_p + doubt).min(), 0.02, 0.98))


def risk_gradient(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float, beta: float = 0.0) -> np.ndarray:
    """Of the risk where its second part is above ``-beta``, and against that part's own gradient where it is not."""
    sa, sb = _sigmoid(p @ w), _sigmoid(u @ w)  # the loss l(g) is the sigmoid of -g
    da, db = p.T @ (sa * (1 - sa)) / len(p), u.T @ (sb * (1 - sb)) / len(u)
    rest = db - prior * da
    return rest - prior * da if sb.mean() - prior * sa.mean() >= -beta else -rest


def fit(positive: np.ndarray, unlabelled: np.ndarray, epochs: int = 40, beta: float = 0.0, seed: int = 1) -> Model:
    """Non-negative positive-unlabelled learning on feature rows."""
    size = CLASSES**3 + DENSE
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(size), 0.0, np.zeros(size), np.ones(size), 0.5)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 0.02
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    prior = estimate_prior(p, u)
    rng = np.random.default_rng(seed)
    p, u = _with_one(p), _with_one(u)
    w, adam = np.zeros(size + 1), _Adam(size + 1, 0.003)
    for a, b in _batches(p, u, epochs, 256, rng):
        adam.step(w, risk_gradient(w, a, b, prior, beta) + 1e-4 * w)
    return Model(w[:-1], float(w[-1]), mean, scale, prior)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([features(t).astype("<f4").tobytes() for t in batch.column("text").to_pylist()], pa.binary())], names=["x"])


def _collected(docs: DataFrame) -> np.ndarray:
    """Features of a bounded sample, by way of the executors."""
    size = CLASSES**3 + DENSE
    rows = sorted(bytes(r["x"]) for r in docs.select("text").mapInArrow(_featured, "x binary").collect())
    return np.frombuffer(b"".join(rows), dtype="<f4").reshape(-1, size).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    ship(docs.sparkSession)
    order = F.xxhash64("doc_id")
    trusted = labels.where((F.col("quality") == 1) & ~held_out(F.col("doc_id"))).select("doc_id").orderBy(order, "doc_id").limit(sample_rows).distinct()
    one = lambda ids: docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    positive = _collected(one(trusted))
    seen = docs.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("doc_id"))
    taken = seen.orderBy(F.xxhash64(F.col("doc_id"), F.lit(1)), "doc_id").limit(sample_rows).distinct()
    unlabelled = _collected(one(taken))
    return fit(positive, unlabelled)


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                x = np.stack([features(t) for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(x).astype(np.float64))], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score, from 0 to 1."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scored(shared), "doc_id long, score double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scores = score(docs, train(docs, labels))
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
