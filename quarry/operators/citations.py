"""Citation strings and numbered lists of sources that can be copied into Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ENCYCLOPEDIA = "wikipedia-en"  # a fixed value: the corpus whose label and provenance differ


def citation(corpus: Column, title: Column, heading_path: Column, timestamp: Column, url: Column, version: Column) -> Column:
    """``label — title § a > b (revision) url``; parts that are empty fall away."""
    wiki = corpus == ENCYCLOPEDIA
    label = F.when(wiki, "Wikipedia").otherwise(corpus)
    some = lambda c: F.when(F.length(c) > 0, c)
    revision = F.when(wiki, some(timestamp)).otherwise(F.coalesce(some(version), some(timestamp)))
    section = F.when(F.size(heading_path) > 0, F.concat(F.lit(" § "), F.array_join(heading_path, " > "))).otherwise("")
    tail = lambda before, c, after: F.coalesce(F.concat(F.lit(before), some(c), F.lit(after)), F.lit(""))
    return F.concat(label, F.lit(" — "), title, section, tail(" (", revision, ")"), tail(" ", url, ""))


def numbered(rows: DataFrame) -> DataFrame:
    """Rows (query_id, position, citation, url): one line for each source in the order of its first place, as
    ``S1``, ``S2`` and so on, with ``\\``, ``[`` and ``]`` escaped."""
    first = rows.groupBy("query_id", "citation", "url").agg(F.min("position").alias("position"))
    order = Window.partitionBy("query_id").orderBy("position", "citation")
    label = F.concat(F.lit("S"), F.row_number().over(order).cast("string"))
    escaped = F.regexp_replace("citation", r"([\\\[\]])", r"\\$1")
    target = F.coalesce(F.concat(F.lit(" <"), F.col("url"), F.lit(">")), F.lit(""))
    return first.withColumn("label", label).withColumn("markdown", F.concat(F.lit("["), F.col("label"), F.lit("] "), escaped, target))
