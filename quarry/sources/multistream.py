"""Dumps that are many compressed streams in one file: blocks from the offset index, parts of blocks, and their pages."""

from __future__ import annotations

import bz2
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.corpus import block_spans, pack_parts
from quarry.runtime import ship

# How much of the file a part covers at most.
PART_BYTES, PART_BLOCKS = 8 << 20, 128
_PAGE = re.compile(rb"<page>.*?</page>", re.S)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``offset:page id:title`` as (offset, page_id, title); a title may have colons."""
    line = F.split("value", ":", 3)
    return spark.read.text(path).where("value <> ''").select(line[0].cast("long").alias("offset"), line[1].cast("long").alias("page_id"), line[2].alias("title"))


def blocks(index: DataFrame, size: int) -> DataFrame:
    """(offset, end, pages) of each stream; the last one ends where the file does."""
    pages = index.groupBy("offset").agg(F.count(F.lit(1)).alias("pages"))
    return block_spans(index, size).join(pages, "offset")


def parts(found: DataFrame) -> list[tuple[int, int, int, int]]:
    """(part, offset, end, pages) of every block; the index of a file has one row a block and is walked in order."""
    rows = [tuple(r) for r in found.select("offset", "end", "pages").orderBy("offset").toLocalIterator()]
    return [(p, *r) for p, r in zip(pack_parts([e - o for o, e, _ in rows], PART_BYTES, PART_BLOCKS), rows, strict=True)]


def _cut(archive: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = (pafs.LocalFileSystem(), re.sub("^file:/+", "/", archive)) if re.match("/|file:", archive) else pafs.FileSystem.from_uri(archive)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(path) as source:
                    source.seek(row["offset"])
                    raw = bz2.decompress(source.read(row["end"] - row["offset"]))
                found = _PAGE.findall(raw)
                if len(found) != row["pages"]:
                    raise ValueError(f"block at {row['offset']} has {len(found)} pages, its index {row['pages']}")
                yield pa.RecordBatch.from_arrays([pa.array([row["offset"]] * len(found), pa.int64()), pa.array([p.decode() for p in found])], names=["offset", "xml"])

    return run


def read_pages(found: DataFrame, archive: str, tasks: int | None = None) -> DataFrame:
    """(offset, xml) of every page; blocks are read independently of each other, as many at once as there are tasks."""
    ship(found.sparkSession)
    spread = found.repartition(tasks) if tasks else found.repartition("offset")
    return spread.select("offset", "end", "pages").mapInArrow(_cut(archive), "offset long, xml string")


def parse_pages(pages: DataFrame) -> DataFrame:
    """The XML of pages in the columns of a dump's rows."""
    from quarry.sources.importers import PAGE

    return pages.select(F.from_xml("xml", PAGE, {"rowTag": "page"}).alias("p")).select("p.*")
