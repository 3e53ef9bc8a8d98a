"""Generations of tables: written beside each other, checked, and published by a pointer that is written last."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.lexical import build_index, Index, plan_queries, search

POINTER = "CURRENT"


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """To a temporary name first, then renamed over what was there, in one step: a reader finds the old text or the
    new one."""
    fs, target = _fs(spark, path)
    context, jvm = spark.sparkContext, spark.sparkContext._jvm
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = context._gateway.new_array(rename, 1)
    options[0] = rename.valueOf("OVERWRITE")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), context._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(draft), fs.makeQualified(target), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def build_id(meta: dict) -> str:
    return hashlib.sha256(canonical(meta).encode()).hexdigest()


def publish(root: str, tables: dict[str, DataFrame], meta: dict, check: Callable[[dict[str, DataFrame]], list[str]] = lambda tables: [], keep: int = 2) -> str:
    """Write ``tables`` as a generation below ``root``, check what was written, and point to it. Nothing that was
    published before changes until then; afterwards only the last ``keep`` generations stay."""
    spark = next(iter(tables.values())).sparkSession
    generation = f"gen-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.option("compression", "zstd").parquet(f"{root}/{generation}/{name}")
    written = {name: spark.read.schema(df.schema).parquet(f"{root}/{generation}/{name}") for name, df in tables.items()}
    problems = check(written)
    if problems:
        fs, path = _fs(spark, f"{root}/{generation}")
        fs.delete(path, True)
        raise ValueError("; ".join(problems))
    meta = {**meta, "rows": {name: df.count() for name, df in written.items()}}
    before = json.loads(read_text(spark, f"{root}/{POINTER}") or "{}").get("generations", [])
    generations = [generation, *before][: max(1, keep)]
    write_text(spark, f"{root}/{POINTER}", canonical({"generation": generation, "generations": generations, "meta": meta, "build_id": build_id(meta)}))
    for old in before:
        if old not in generations:
            fs, path = _fs(spark, f"{root}/{old}")
            fs.delete(path, True)
    return generation


def current(spark: SparkSession, root: str) -> tuple[dict, Callable[[str], DataFrame]]:
    """(metadata, reader of a table by name) of what is published."""
    raw = read_text(spark, f"{root}/{POINTER}")
    if raw is None:
        raise FileNotFoundError(f"nothing is published at {root}")
    known = json.loads(raw)
    return known, lambda name: spark.read.parquet(f"{root}/{known['generation']}/{name}")


def check_corpus(tables: dict[str, DataFrame]) -> list[str]:
    """Unique keys, no chunk without its document, character counts that hold."""
    documents, chunks = tables["documents"], tables["chunks"]
    found = []
    for name, df, key in (("documents", documents, "document_id"), ("chunks", chunks, "chunk_instance_id")):
        if df.groupBy(key).count().where("count > 1").limit(1).count():
            found.append(f"{name}: {key} repeats")
    if chunks.join(documents.select("document_id"), "document_id", "left_anti").limit(1).count():
        found.append("chunks: a document is missing")
    if chunks.where(F.col("character_count") != F.length("text")).limit(1).count():
        found.append("chunks: a character count is wrong")
    return found


def publish_index(root: str, chunks: DataFrame, meta: dict | None = None) -> str:
    """The inverted index of chunks as a generation. Postings are dealt and sorted by term, so that a search reads
    few row groups."""
    index = build_index(chunks)
    tables = {"postings": index.postings.repartition("term").sortWithinPartitions("term", "row_id"), "lengths": index.lengths, "corpus": index.corpus}
    return publish(root, tables, {"schema": 2, "tokenizer": "letters and numbers, folded", **(meta or {})}, lambda t: [] if t["corpus"].count() == 1 else ["corpus figures are missing"])


def open_index(spark: SparkSession, root: str) -> Index:
    _, read = current(spark, root)
    return Index(read("postings"), read("lengths"), read("corpus"))


def verify_index(spark: SparkSession, root: str, smoke: list[str] = ()) -> list[str]:
    """What is wrong with a published index: numbers of rows, postings without a row or that do not add up to a row's
    length, and queries that must find something and do not."""
    known, read = current(spark, root)
    index, found = Index(read("postings"), read("lengths"), read("corpus")), []
    for name, rows in known["meta"]["rows"].items():
        if read(name).count() != rows:
            found.append(f"{name}: the number of rows is not the one that was published")
    per_row = index.postings.groupBy("row_id").agg(F.sum("tf").alias("held"))
    apart = per_row.join(index.lengths, "row_id", "full_outer").where(F.coalesce("held", F.lit(0)) != F.coalesce("dl", F.lit(-1)))
    if apart.limit(1).count():
        found.append("postings and lengths do not agree")
    figures, counted = index.corpus.first(), index.lengths.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl")).first()
    if figures["n"] != counted["n"] or abs((figures["avgdl"] or 0) - (counted["avgdl"] or 0)) > 1e-9:
        found.append("the corpus' figures are not those of its rows")
    for query in smoke:
        if not search(index, plan_queries(spark, [("q", query, "and")]), 1).limit(1).count():
            found.append(f"{query!r} finds nothing")
    return found
