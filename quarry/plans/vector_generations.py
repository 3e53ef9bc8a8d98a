"""Vector generations: embedding that can be taken up again, reuse of what is unchanged, publication and verification.

Texts are embedded once each, by their hash, in slices of the hash space. A slice is a table of its own below a folder
that bears the provider's identity; after a stop, slices that were written whole are not made again. Vectors of the
generation that is published are reused if the same provider made them. A generation is published only if its ids
are dense, its vectors usable, every vector has its record, and a vector finds itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.vectors import is_usable
from quarry.operators import semantic
from quarry.plans import publish
from quarry.runtime import shuffle_partitions, stored

SLICES = 16
SCHEMA = 2


def dense_ids(rows: DataFrame, key: str, into: str = "vector_id") -> DataFrame:
    """``rows`` numbered from zero in the order of ``key``: each range partition numbers its own, and one count a
    partition tells where it begins."""
    spark = rows.sparkSession
    placed = rows.repartitionByRange(shuffle_partitions(spark), key).sortWithinPartitions(key)
    place = F.monotonically_increasing_id()
    placed = stored(placed.withColumns({"_part": F.shiftright(place, 33), "_n": place.bitwiseAND((1 << 33) - 1)}), "numbered")
    starts, total = [], 0
    for r in sorted(placed.groupBy("_part").count().collect(), key=lambda r: r["_part"]):  # one row a partition
        starts.append((r["_part"], total))
        total += r["count"]
    begin = F.broadcast(spark.createDataFrame(starts, "_part long, _start long"))
    return placed.join(begin, "_part").withColumn(into, F.col("_start") + F.col("_n")).drop("_part", "_n", "_start")


def _published(spark: SparkSession, root: str, identity: dict) -> DataFrame | None:
    """fingerprint and embedding of the generation at ``root``, if there is one of the same provider."""
    try:
        known, read = publish.current(spark, root)
    except FileNotFoundError:
        return None
    return read("vectors").select("fingerprint", "embedding") if known["meta"].get("provider") == identity else None


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = publish._fs(spark, path)
    return fs.exists(where)


def _slice(root: str, identity: dict, k: int) -> str:
    name = hashlib.sha256(publish.canonical(identity).encode()).hexdigest()[:16]
    return f"{root}/.building-{name}/slice-{k:04d}"


def embed_missing(root: str, texts: DataFrame, provider: Callable[[list[str]], np.ndarray], identity: dict, known: DataFrame | None, slices: int = SLICES, stop_after: int | None = None) -> DataFrame | None:
    """fingerprint and embedding of the distinct ``texts`` (fingerprint, text) that ``known`` lacks, slice by slice.
    With ``stop_after``, so many slices at most are made in this run, and nothing is returned if others are left."""
    spark = texts.sparkSession
    todo = texts.groupBy("fingerprint").agg(F.min("text").alias("text"))
    todo = todo if known is None else todo.join(known.select("fingerprint"), "fingerprint", "left_anti")
    todo = stored(todo, "to-embed")
    made = 0
    for k in range(slices):
        path = _slice(root, identity, k)
        if _exists(spark, f"{path}/_SUCCESS"):
            continue
        if stop_after is not None and made >= stop_after:
            return None
        own = todo.where(F.pmod(F.xxhash64("fingerprint"), F.lit(slices)) == k)
        semantic.embed(own, provider).select("fingerprint", "embedding").write.mode("overwrite").option("compression", "zstd").parquet(path)
        made += 1
    return spark.read.parquet(*(_slice(root, identity, k) for k in range(slices)))


def problems(vectors: DataFrame, dims: int, probe: bool = True) -> list[str]:
    """What is wrong with a generation's table (vector_id, id, fingerprint, embedding)."""
    row = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.min("vector_id").alias("least"), F.max("vector_id").alias("most"), F.count_distinct("vector_id").alias("ids"), F.count_distinct("id").alias("records"),
        F.sum((~F.coalesce(is_usable(F.col("embedding"), dims), F.lit(False))).cast("int")).alias("unusable"), F.sum((F.col("id").isNull() | F.col("fingerprint").isNull()).cast("int")).alias("orphans"),
    ).first()
    n, found = row["n"], []
    if n and (row["least"], row["most"], row["ids"]) != (0, n - 1, n):
        found.append("vector ids are not 0 to n - 1")
    if n and row["records"] + row["orphans"] != n:
        found.append("a record has several vectors")
    found += [f"{row[k]} {why}" for k, why in (("unusable", "vectors are unusable"), ("orphans", "vectors have no record")) if row[k]]
    if n and probe and not found:
        one = vectors.where("vector_id = 0").select(F.col("vector_id").alias("query_id"), "embedding")
        hit = semantic.top_k(vectors.select(F.col("vector_id").alias("vec_id"), "embedding"), one, 1).first()
        if hit is None or abs(hit["score"] - 1) > 1e-6:
            found.append("the first vector does not find itself")
    return found


def build_vectors(root: str, records: DataFrame, provider: Callable[[list[str]], np.ndarray], dims: int, identity: dict, source: str | None = None, slices: int = SLICES, stop_after: int | None = None) -> str | None:
    """Publish vectors for ``records`` (id, text) below ``root``; the generation's name, or nothing if stopped before
    all slices were made. ``identity`` tells of the provider, ``source`` is the build id of the index that the records
    come from."""
    spark = records.sparkSession
    identity = {**identity, "dims": dims}
    wanted = stored(records.select("id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("fingerprint")), "vector-records")
    known = _published(spark, root, identity)
    reused = None if known is None else known.dropDuplicates(["fingerprint"])
    fresh = embed_missing(root, wanted.select("fingerprint", "text"), provider, identity, reused, slices, stop_after)
    if fresh is None:
        return None
    every = fresh if reused is None else fresh.unionByName(reused.join(fresh.select("fingerprint"), "fingerprint", "left_anti"))
    vectors = dense_ids(wanted.drop("text").join(every, "fingerprint", "left"), "id")
    n_reused = 0 if reused is None else wanted.join(reused.select("fingerprint"), "fingerprint", "left_semi").count()
    meta = {"schema": SCHEMA, "provider": identity, "dims": dims, "source": source, "reused": n_reused}
    name = publish.publish(root, {"vectors": vectors}, meta, lambda tables: problems(tables["vectors"], dims))
    fs, folder = publish._fs(spark, _slice(root, identity, 0).rpartition("/")[0])
    fs.delete(folder, True)
    return name


def verify_vectors(spark: SparkSession, root: str, source: str | None = None, identity: dict | None = None) -> list[str]:
    """What is wrong with the generation that is published, the index that it belongs to and its provider included."""
    known, read = publish.current(spark, root)
    meta, vectors = known["meta"], read("vectors")
    found = problems(vectors, meta["dims"])
    if vectors.count() != meta["rows"]["vectors"]:
        found.append("the number of vectors is not the one that was published")
    if source is not None and meta["source"] != source:
        found.append("the vectors belong to another build of the index")
    if identity is not None and meta["provider"] != {**identity, "dims": meta["dims"]}:
        found.append("another provider made the vectors")
    return found


def open_vectors(spark: SparkSession, root: str) -> DataFrame:
    """vec_id, which is a record's id, and embedding."""
    _, read = publish.current(spark, root)
    return read("vectors").select(F.col("id").alias("vec_id"), "embedding")
