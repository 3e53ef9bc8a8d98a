"""Exact vector search: batches of queries against all vectors, and the upkeep of a vector index."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.vectors import is_usable, normalize
from quarry.runtime import in_slices, ship, stored

MOST_QUERIES = 4096  # of one block: what is sent to every task has at most so many vectors
MOST_HELD = 1 << 20  # best rows of one block's queries: what a task holds
SLICE_QUERIES, SLICE_VECTORS = 256, 2048  # of which the scores are made at once
MOST_RESULTS = 1000
MOST_POOL = 20_000  # chunks that are looked at for the documents of a result


def _best(blocks, limit: int, digits: int):
    """The best rows of a task for each query. Scores are made for a few queries and vectors at a time; what is held
    between them is the best so far, by rounded score and then id, as the ranking has it."""
    unit = 10.0**digits

    def leading(parts: list[tuple]) -> tuple:
        q, key, vec, score = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((vec, -key, q))
        ordered = q[order]
        order = order[np.arange(len(ordered)) - np.searchsorted(ordered, ordered) < limit]
        return q[order], key[order], vec[order], score[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = blocks.value
        starts = range(0, len(queries), SLICE_QUERIES)
        held: dict[int, tuple] = {}
        least = np.full(len(queries), -np.inf)  # of a query that has all its rows, the last one's score
        for batch in in_slices(batches, SLICE_VECTORS):
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            rows = flat.reshape(batch.num_rows, -1).T
            vec = batch.column("vec_id").to_numpy(zero_copy_only=False)
            for at in starts:
                scores = queries[at : at + SLICE_QUERIES] @ rows
                bar = least[at : at + SLICE_QUERIES]
                if batch.num_rows > limit and np.isinf(bar).any():
                    bar = np.maximum(bar, np.partition(scores, batch.num_rows - limit, axis=1)[:, batch.num_rows - limit])
                q, v = np.nonzero(scores >= (bar - 2 / unit)[:, None])  # all that may round to the bar: their ids decide
                if len(q):
                    score = scores[q, v]
                    fresh = (q, np.trunc(score * unit + np.copysign(0.5, score)).astype(np.int64), vec[v], score)
                    held[at] = q, key, _, _ = leading([held[at], fresh] if at in held else [fresh])
                    ends = np.cumsum(np.bincount(q, minlength=len(bar)))
                    full = np.flatnonzero(np.diff(ends, prepend=0) == limit)
                    least[at + full] = key[ends[full] - 1] / unit
        for at in list(held):
            q, key, vec, score = held.pop(at)
            yield pa.RecordBatch.from_arrays([pa.array(ids[at + q]), pa.array(vec), pa.array(score), pa.array(key)], names=["query_id", "vec_id", "score", "_key"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, limit: int, digits: int = 9, most: int = MOST_RESULTS) -> DataFrame:
    """(query_id, vec_id, score, rank): exact inner products of normalised vectors, ties by vec_id.

    ``vectors`` has vec_id and embedding, ``queries`` query_id and embedding. Queries go out in blocks of a fixed
    size, smaller for long results; each task passes on only its own best for each query.
    """
    if not 1 <= limit <= most:
        raise ValueError(f"limit lies between 1 and {most}")
    spark = vectors.sparkSession
    ship(spark)
    usable = vectors.where(is_usable(F.col("embedding"))).select("vec_id", normalize(F.col("embedding")).alias("embedding"))
    asked = queries.where(is_usable(F.col("embedding"))).select("query_id", normalize(F.col("embedding")).alias("embedding"))
    order = Window.partitionBy("query_id").orderBy(F.col("_key").desc(), "vec_id")

    def search(block: list) -> tuple[DataFrame, Broadcast]:
        shared = spark.sparkContext.broadcast((np.array([r["query_id"] for r in block]), np.array([r["embedding"] for r in block], dtype=np.float64)))
        found = usable.mapInArrow(_best(shared, limit, digits), "query_id long, vec_id long, score double, _key long")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).drop("_key"), shared

    done, rows = [], asked.toLocalIterator()
    size = max(1, min(MOST_QUERIES, MOST_HELD // limit))
    block = list(itertools.islice(rows, size))
    while following := list(itertools.islice(rows, size)):  # a block is answered and its broadcast given up before the next is sent
        found, shared = search(block)
        done.append(stored(found, "nearest"))
        shared.destroy()
        block = following
    last = search(block)[0] if block else spark.createDataFrame([], "query_id long, vec_id long, score double, rank int")
    return functools.reduce(DataFrame.unionByName, [*done, last])


def best_per_group(ranked: DataFrame, group: str, limit: int) -> DataFrame:
    """Of each query's ranked rows the first of every group, then the best groups."""
    own = Window.partitionBy("query_id", group).orderBy("rank")
    kept = ranked.withColumn("_k", F.row_number().over(own)).where("_k = 1").drop("_k")
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))).where(F.col("rank") <= limit)


def pool_size(n: int, limit: int) -> int:
    """How many chunks are looked at so that ``limit`` documents come of them."""
    return min(n, MOST_POOL, max(256, 64 * limit))


def embed(texts: DataFrame, provider: Callable[[list[str]], np.ndarray], column: str = "text") -> DataFrame:
    """``texts`` with ``embedding`` by a provider of float rows, batch by batch; rows of wrong numbers are refused."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.asarray(provider([t or "" for t in batch.column(column).to_pylist()]), dtype=np.float32)
            if found.shape[0] != batch.num_rows or not np.isfinite(found).all() or (batch.num_rows and (np.linalg.norm(found, axis=1) == 0).any()):
                raise ValueError("the provider returned unusable vectors")
            unit = found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-30)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(unit.tolist(), pa.list_(pa.float32()))], names=[*batch.schema.names, "embedding"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema)
    return texts.mapInArrow(run, f"{fields}, embedding array<float>")


def instructed(query: str, task: str) -> str:
    """A query as models that were trained with instructions want it; documents go as they are."""
    return f"Instruct: {task}\nQuery: {query}" if task else query


def keyword_provider(groups: list[list[str]]) -> Callable[[list[str]], np.ndarray]:
    """A deterministic provider without a model: one dimension for each group of key words, and a small constant."""

    def provide(texts: list[str]) -> np.ndarray:
        rows = [[float(any(w in t.casefold() for w in g)) for g in groups] + [0.01] for t in texts]
        return np.array(rows, dtype=np.float32).reshape(len(texts), len(groups) + 1)

    return provide


def reuse_plan(new: DataFrame, old: DataFrame, by_document: bool = True) -> DataFrame:
    """``new`` (id, fingerprint) with the old vector that serves it, or null where it must be embedded. By document:
    the same id with the same fingerprint; otherwise the smallest old vector_id of the fingerprint."""
    if by_document:
        return new.join(old.select("id", "fingerprint", "vector_id"), ["id", "fingerprint"], "left")
    least = old.groupBy("fingerprint").agg(F.min("vector_id").alias("vector_id"))
    return new.join(least, "fingerprint", "left")


def verify_vectors(vectors: DataFrame, dims: int) -> DataFrame:
    """One row: rows, smallest and largest vector_id, whether ids are 0 to n - 1 without gaps, unusable vectors."""
    found = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.min("vector_id").alias("least"), F.max("vector_id").alias("most"), F.countDistinct("vector_id").alias("ids"),
        F.sum((~is_usable(F.col("embedding"), dims)).cast("int")).cast("long").alias("unusable"),
    )
    return found.withColumn("contiguous", (F.col("n") == F.col("ids")) & F.coalesce(F.col("least") == 0, F.lit(True)) & F.coalesce(F.col("most") == F.col("n") - 1, F.lit(True)))
