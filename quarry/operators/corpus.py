"""Chunks in order, reads of documents and contexts, comparison of corpus generations, and integrity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def neighbours(chunks: DataFrame, document: str = "document_id", order: str = "ordinal", chunk: str = "chunk_id") -> DataFrame:
    """Dense ordinals from zero and the ids before and after, within each document."""
    window = Window.partitionBy(document).orderBy(order, chunk)
    return chunks.withColumns({"dense_ordinal": F.row_number().over(window) - 1, "previous_chunk_id": F.lag(chunk).over(window), "next_chunk_id": F.lead(chunk).over(window)})


def document_page(chunks: DataFrame, document_id, offset: int, limit: int, document: str = "document_id", order: str = "ordinal") -> DataFrame:
    """A page of a document's chunks in order, with the total and whether more follow."""
    if offset < 0 or not 1 <= limit <= 200:
        raise ValueError("offset is at least 0 and limit lies between 1 and 200")
    own = chunks.where(F.col(document) == document_id)
    total = own.agg(F.count(F.lit(1)).alias("total"))
    return own.orderBy(order).offset(offset).limit(limit).crossJoin(F.broadcast(total)).withColumn("has_more", F.lit(offset + limit) < F.col("total"))  # one row


def context(chunks: DataFrame, anchors: DataFrame, before: int = 1, after: int = 1, document: str = "document_id", order: str = "ordinal") -> DataFrame:
    """The chunks around each anchor (document, ordinal): ``before + after + 1`` of them from ``before`` places ahead; at
    a document's start the window begins with its first chunk and is as long."""
    if not (0 <= before <= 5 and 0 <= after <= 5):
        raise ValueError("before and after lie between 0 and 5")
    start = F.greatest(F.lit(0), F.col("anchor") - before)
    spans = anchors.select(F.col(document), F.col(order).alias("anchor")).withColumn("start", start)
    inside = (F.col(order) >= F.col("start")) & (F.col(order) <= F.col("start") + (before + after))
    return chunks.join(spans, document).where(inside)


def lead_text(chunks: DataFrame, most_chunks: int, most_chars: int, document: str = "document_id", order: str = "ordinal", title: str = "title") -> DataFrame:
    """A document as its title and the texts of its first chunks, parted by blank lines and cut. Documents without
    such a chunk are left out."""
    head = chunks.where(F.col(order) < most_chunks)
    texts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("text").alias("t"))))  # at most most_chunks
    body = F.array_join(F.transform(texts, lambda c: c["t"]), "\n\n")
    return head.groupBy(document).agg(F.min(title).alias("title"), body.alias("_body")).select(document, F.substring(F.concat("title", F.lit("\n\n"), "_body"), 1, most_chars).alias("embedding_text"))


def chunk_representation(title: Column, heading_path: Column, text: Column, most_chars: int) -> Column:
    """``Title: ...``, ``Section: a > b`` and the body, within a number of characters."""
    section = F.when(F.size(heading_path) > 0, F.concat(F.lit("\nSection: "), F.array_join(heading_path, " > "))).otherwise(F.lit(""))
    return F.substring(F.concat(F.lit("Title: "), title, section, F.lit("\n\n"), text), 1, most_chars)


def update_plan(old: DataFrame, new: DataFrame, key: str = "document_id", content: str = "content_hash") -> DataFrame:
    """Every document of two generations as unchanged, modified, added or deleted."""
    a, b = old.select(F.col(key), F.col(content).alias("_old")), new.select(F.col(key), F.col(content).alias("_new"))
    joined = a.withColumn("_in_old", F.lit(True)).join(b.withColumn("_in_new", F.lit(True)), key, "full_outer")
    kind = F.when(F.col("_in_old").isNull(), "added").when(F.col("_in_new").isNull(), "deleted").when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("modified")
    return joined.select(key, kind.alias("change"))


def update_summary(plan: DataFrame, samples: int = 5, key: str = "document_id") -> DataFrame:
    """The number of documents of each kind and the first ids; the window passes on a few rows a task."""
    counts = plan.groupBy("change").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("change").orderBy(key)
    first = plan.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= samples)
    listed = first.groupBy("change").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", F.col(key).cast("string").alias("i")))), lambda s: s["i"]), ",").alias("samples"))
    return counts.join(listed, "change")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows whose key the parent lacks."""
    return child.join(parent.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")


def contiguity(rows: DataFrame, column: str) -> DataFrame:
    """Whether a column counts from its least value without gaps or repeats."""
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(column).alias("n_distinct"), F.min(column).alias("least"), F.max(column).alias("most"))
    return found.withColumn("contiguous", (F.col("n") == F.col("n_distinct")) & (F.col("most") - F.col("least") + 1 == F.col("n")))


def forward_fill(rows: DataFrame, column: str, partition: str, order: str) -> DataFrame:
    """The last value that is not null, from the row itself back."""
    window = Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(column, F.last(column, ignorenulls=True).over(window))


def block_spans(offsets: DataFrame, size: int, column: str = "offset") -> DataFrame:
    """Distinct offsets as spans: each ends where the next begins, the last at the file's size."""
    window = Window.orderBy(column)  # a file's index of blocks
    return offsets.select(column).distinct().withColumn("end", F.coalesce(F.lead(column).over(window), F.lit(size)))


def even_samples(n: int, k: int) -> list[int]:
    """k places of n, evenly spread, first and last among them; halves round to even."""
    if k >= n:
        return list(range(n))
    return [0] if k == 1 else [round(i * (n - 1) / (k - 1)) for i in range(k)]


def pack_parts(sizes: list[int], most_bytes: int, most_blocks: int) -> list[int]:
    """The part of each block: a part is closed when the next block would exceed its bytes or its number."""
    parts, part, held, count = [], 0, 0, 0
    for size in sizes:
        if count and (held + size > most_bytes or count >= most_blocks):
            part, held, count = part + 1, 0, 0
        parts.append(part)
        held, count = held + size, count + 1
    return parts


def storage_projection(sampled: DataFrame, total: Column, bytes_column: str = "bytes") -> DataFrame:
    """Bytes of the sampled parts carried on to all of them in proportion."""
    return sampled.agg(F.count(F.lit(1)).alias("sampled_parts"), F.sum(bytes_column).alias("sampled_bytes")).withColumn("projected_bytes", F.floor(F.col("sampled_bytes") * total / F.col("sampled_parts")))


def retain_answers(posts: DataFrame) -> DataFrame:
    """Of posts (id, kind, parent_id, accepted_id, score) the questions, and their answers that are accepted or have a
    score above zero, accepted first, then by score."""
    questions = posts.where("kind = 'question'").select(F.col("id").alias("parent_id"), F.col("accepted_id").alias("_accepted"))
    answers = posts.where("kind = 'answer'").drop("accepted_id").join(questions, "parent_id").withColumn("accepted", F.coalesce(F.col("id") == F.col("_accepted"), F.lit(False)))
    order = Window.partitionBy("parent_id").orderBy(F.col("accepted").desc(), F.col("score").desc(), "id")
    return answers.where(F.col("accepted") | (F.col("score") > 0)).withColumn("place", F.row_number().over(order)).drop("_accepted")


def keyset_page(rows: DataFrame, key: str, after, limit: int) -> DataFrame:
    """The next rows behind a key, in its order: a stream of pages that no offset makes dearer."""
    further = rows if after is None else rows.where(F.col(key) > F.lit(after))
    return further.orderBy(key).limit(limit)


def evidence_columns(rows: DataFrame, attributes: str = "attributes") -> DataFrame:
    """``rows`` with what their open JSON field says of the evidence."""
    said = lambda name: F.get_json_object(attributes, f"$.{name}")
    timestamp = F.col("source_timestamp") if "source_timestamp" in rows.columns else F.lit(None).cast("string")
    some = lambda c: F.when(F.length(c) > 0, c)
    return rows.withColumns({
        "front_matter": F.coalesce(said("front_matter") == "true", F.lit(False)),
        "derived_evidence": F.coalesce(said("derived_evidence") == "true", F.lit(False)),
        "procedure_method": said("procedure_method"),
        "evidence_kind": F.coalesce(some(said("evidence_kind")), F.when(F.length(said("procedure_method")) > 0, "procedure_method"), F.lit("source_chunk")),
        "revision_timestamp": F.coalesce(some(said("revision_timestamp")), timestamp),
    })


def occurrences_by_module(occurrences: DataFrame, module: str, place: list[str]) -> DataFrame:
    """``module`` with its places in all books, in order: (book, ordinal and what else ``place`` names)."""
    return occurrences.groupBy(module).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct(*place))).alias("occurrences"))
