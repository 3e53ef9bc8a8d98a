"""Records of documents and chunks: coercion of both record forms, validation, and what a build may read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import content_id
from quarry.operators.corpus import neighbours
from quarry.runtime import ship
from quarry.schema import SCHEMA_VERSION

# Members of the older encyclopedia records that have a column of their own.
LEGACY_DOCUMENT = "document_id page_id title url revision_id revision_timestamp license content_hash redirect".split()
LEGACY_CHUNK = "chunk_id document_id section_index chunk_index heading_path text character_count".split()


def is_native(records: DataFrame) -> bool:
    """Records of one form only: native ones name their corpus, older ones do not."""
    if "corpus" not in records.columns:
        return False
    mixed = records.agg(F.countDistinct(F.col("corpus").isNull())).first()[0]
    if mixed > 1:
        raise ValueError("records of both forms in one input")
    return bool(records.where("corpus IS NOT NULL").limit(1).count())


def other_members(records: DataFrame, known: list[str]) -> Column:
    """Columns without a place of their own, as a JSON object; those that are null are left out."""
    rest = sorted(c for c in records.columns if c not in known)
    return F.to_json(F.struct(*rest)) if rest else F.lit("{}")


def legacy_documents(records: DataFrame, corpus: str = "wikipedia-en") -> DataFrame:
    text = lambda name: (F.col(name) if name in records.columns else F.lit(None)).cast("string")
    return records.select(
        text("document_id").alias("document_id"), F.lit(corpus).alias("corpus"), text("title").alias("title"), text("url").alias("source_url"), text("revision_id").alias("source_version"),
        text("revision_timestamp").alias("source_timestamp"), text("license").alias("license"), text("content_hash").alias("content_hash"), other_members(records, LEGACY_DOCUMENT).alias("attributes"), F.lit(SCHEMA_VERSION).alias("schema_version"),
    )


def legacy_chunks(records: DataFrame) -> DataFrame:
    """Ordinals and neighbours come from the sections' order."""
    ship(records.sparkSession)
    place = F.struct("section_index", "chunk_index")
    linked = neighbours(records.withColumn("_place", place), "document_id", "_place", "chunk_id")
    return linked.select(
        F.col("chunk_id").alias("chunk_instance_id"), content_id(F.col("text")).alias("content_id"), "document_id", F.lit(None).cast("string").alias("parent_chunk_id"), F.col("dense_ordinal").cast("int").alias("ordinal"),
        F.coalesce("heading_path", F.array().cast("array<string>")).alias("heading_path"), "text", F.length("text").alias("character_count"), F.lit(None).cast("int").alias("token_count"), "previous_chunk_id", "next_chunk_id",
        other_members(records, [c for c in LEGACY_CHUNK if c not in ("section_index", "chunk_index")]).alias("attributes"), F.lit(SCHEMA_VERSION).alias("schema_version"),
    )


def problems(records: DataFrame, required: list[str], count: bool = False) -> DataFrame:
    """Records with what is wrong with them: required texts that are missing or blank, counts that do not hold."""
    wrong = [F.when(F.coalesce(F.trim(c) == "", F.lit(True)), f"{c} is missing") for c in required]
    if count:
        wrong += [F.when(F.col("ordinal") < 0, "ordinal is negative"), F.when(~F.coalesce(F.col("character_count") == F.length("text"), F.lit(False)), "character_count is wrong")]
    return records.withColumn("problems", F.filter(F.array(*wrong), lambda w: w.isNotNull())).where(F.size("problems") > 0)


def manifest_parts(manifest: dict) -> list[tuple[int, str, str]]:
    """(number, documents, chunks) of a manifest's parts in order; numbers are unique and paths stay inside."""
    parts = [(p["part"], p["documents"], p["chunks"]) for p in manifest.get("parts", [])]
    if len({n for n, _, _ in parts}) != len(parts):
        raise ValueError("a part's number repeats")
    for _, *paths in parts:
        for path in paths:
            if path.startswith(("/", "\\")) or ".." in path.replace("\\", "/").split("/") or ":" in path:
                raise ValueError(f"path {path} leaves the folder")
    return sorted(parts)


def require_complete(stats: dict, allow_incomplete: bool = False) -> None:
    """An extraction that was stopped early is refused."""
    if not allow_incomplete and not stats.get("complete", stats.get("stop_reason") in (None, "end_of_input")):
        raise ValueError(f"the extraction is not complete: {stats.get('stop_reason', 'unknown')}")


def fingerprint(inventory: DataFrame) -> str:
    """One hash of a listing (relative, length, sha256): it changes with any file, not with the folder's place."""
    row = inventory.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("relative", "length", "sha256")).alias("x"), F.sum(F.col("length")).alias("bytes"))
    return row.select(F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("n", "x", "bytes"))), 256)).first()[0]


def read_parts(spark: SparkSession, folder: str, manifest: dict, kind: str, schema: str) -> DataFrame:
    """The records of all of a manifest's parts (``documents`` or ``chunks``) with their part's number."""
    out = None
    for number, documents, chunks in manifest_parts(manifest):
        path = f"{folder.rstrip('/')}/{documents if kind == 'documents' else chunks}"
        part = spark.read.schema(schema).option("mode", "FAILFAST").json(path).withColumn("part", F.lit(number))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], f"{schema}, part int")


def require_unchanged(before: DataFrame, after: DataFrame) -> None:
    """Two listings (relative, length) of one folder, before and after it was read: any difference is an error."""
    changed = before.join(after.withColumnRenamed("length", "now"), "relative", "full_outer").where(~F.col("length").eqNullSafe(F.col("now"))).select("relative").first()
    if changed:
        raise ValueError(f"{changed['relative']} changed while it was read")
