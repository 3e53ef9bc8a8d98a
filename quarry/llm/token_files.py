"""Token ids in binary files of independent zstandard frames with a trailing seek table.

A file holds, one after another: data frames, each an independent zstandard frame over the ids of consecutive
documents; an index, a skippable frame; and the seek table of zstandard's seekable format, a skippable frame with
the compressed size, the size and the low 32 bits of the XXH64 checksum of every data frame, so that standard tools
read the files, too. A data frame's content is::

    u32 documents | i64 doc_id each | u8 doc_id is null, each | u32 tokens each | u32 ids of all

and the index's content is, for each data frame, ``i64 last doc_id | u64 tokens before it in the file | u32 documents``.
A reader of some documents reads the two tables at the file's end, finds their frames, and decompresses those alone.

Documents are range-partitioned and sorted by doc_id; each task streams its range into one file under a temporary
name, which is then renamed to the name of its partition: a task that runs twice writes the same file. Paths are
URIs that pyarrow's filesystems resolve; Hadoop's names of stores (``s3a``, ``s3n``, ``wasbs``) are taken for theirs.

Cases: a null or empty text is the end id alone; null doc_ids come first; rows that share a doc_id, or have none,
follow each other by a hash of the text, and may fill several files; a very long text is a frame of its own; an empty table gives no files and an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.tokens import encoder
from quarry.runtime import scratch_path, ship, shuffle_partitions, stored

FRAME_TOKENS = 1 << 16
SEEK_MAGIC, INDEX_MAGIC, FOOTER_MAGIC = 0x184D2A5E, 0x184D2A5D, 0x8F92EAB1
_ENTRY = struct.Struct("<qQI")
_NULL_ID = -(1 << 63)
#: Hadoop's names of stores, and pyarrow's.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    if folder.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    if folder.startswith("/"):
        return pafs.LocalFileSystem(), folder
    scheme, rest = folder.split("://", 1)
    return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")


@dataclass
class Frame:
    """Where a data frame lies in its file, and what it holds."""

    offset: int
    stored: int
    size: int
    checksum: int
    last_id: int
    tokens_before: int
    documents: int


class Writer:
    """Writes documents, given in ascending doc_id order, to an open stream."""

    def __init__(self, out, frame_tokens: int = FRAME_TOKENS):
        self.out, self.frame_tokens = out, frame_tokens
        self.frames: list[Frame] = []
        self.at = self.tokens = self.documents = self._held = 0
        self._ids: list[int | None] = []
        self._tokens: list[bytes] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._ids.append(doc_id)
        self._tokens.append(ids)
        self._held += len(ids) // 4
        if self._held >= self.frame_tokens:
            self._flush()

    def _flush(self) -> None:
        if not self._ids:
            return
        n = len(self._ids)
        known = np.array([_NULL_ID if i is None else i for i in self._ids], dtype="<i8")
        lengths = np.fromiter(map(len, self._tokens), dtype="<u4", count=n) // 4
        raw = struct.pack("<I", n) + known.tobytes() + bytes(i is None for i in self._ids) + lengths.tobytes() + b"".join(self._tokens)
        packed = zstandard.ZstdCompressor(level=3, write_checksum=True).compress(raw)
        self.out.write(packed)
        self.frames.append(Frame(self.at, len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF, int(known[-1]), self.tokens, n))
        self.at += len(packed)
        self.tokens += self._held
        self.documents += n
        self._ids, self._tokens, self._held = [], [], 0

    def close(self) -> None:
        self._flush()
        index = b"".join(_ENTRY.pack(f.last_id, f.tokens_before, f.documents) for f in self.frames)
        table = b"".join(struct.pack("<III", f.stored, f.size, f.checksum) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index + struct.pack("<II", SEEK_MAGIC, len(table)) + table)


class Reader:
    """Random access to a file: the tables at its end are read first, data frames only on demand."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        n, _, magic = struct.unpack("<IBI", self._read(end - 9, 9))
        if magic != FOOTER_MAGIC:
            raise ValueError("no seek table at the end of the file")
        table_at = end - 9 - 12 * n - 8
        table = self._read(table_at, 8 + 12 * n)
        index_at = table_at - _ENTRY.size * n - 8
        index = self._read(index_at, table_at - index_at)
        if struct.unpack_from("<I", table)[0] != SEEK_MAGIC or struct.unpack_from("<I", index)[0] != INDEX_MAGIC:
            raise ValueError("the file's tables are damaged")
        self.frames, at = [], 0
        for (stored_, size, checksum), (last, before, documents) in zip(struct.iter_unpack("<III", table[8:]), _ENTRY.iter_unpack(index[8:]), strict=True):
            self.frames.append(Frame(at, stored_, size, checksum, last, before, documents))
            at += stored_

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def frame(self, k: int) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, tokens of the file before it, ids) of each document in the frame; the checksum is verified."""
        f = self.frames[k]
        raw = zstandard.ZstdDecompressor().decompress(self._read(f.offset, f.stored), max_output_size=f.size)
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != f.checksum:
            raise ValueError(f"frame {k} fails its checksum")
        n = struct.unpack_from("<I", raw)[0]
        ids = np.frombuffer(raw, dtype="<i8", count=n, offset=4).tolist()
        null = raw[4 + 8 * n : 4 + 9 * n]
        lengths = np.frombuffer(raw, dtype="<u4", count=n, offset=4 + 9 * n).tolist()
        at, start = 4 + 13 * n, f.tokens_before
        for doc_id, none, length in zip(ids, null, lengths, strict=True):
            yield None if none else doc_id, start, raw[at : at + 4 * length]
            at += 4 * length
            start += length

    def documents(self, wanted: Iterable[int]) -> Iterator[tuple[int | None, int, bytes]]:
        """The documents with these ids, from the frames that may hold them."""
        wanted = np.unique(np.fromiter(wanted, dtype=np.int64))
        lasts = np.array([f.last_id for f in self.frames], dtype=np.int64)
        lo, hi = np.searchsorted(lasts, wanted, "left"), np.searchsorted(lasts, wanted, "right")
        own = set(wanted.tolist())
        for k in sorted({k for a, b in zip(lo, hi, strict=True) for k in range(a, min(b + 1, len(self.frames)))}):
            yield from (row for row in self.frame(k) if row[0] in own)


_MANIFEST = "part int, file string, frames int, documents long, tokens long"


def _written(folder: str, tokenizer: str, end_id: int, frame_tokens: int):
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                part = TaskContext.get().partitionId()
                fs, root = _open(folder)
                fs.create_dir(root, recursive=True)
                name = f"part-{part:06d}.tokens"
                own = f"{root}/.{name}-{uuid.uuid4().hex}"
                out = fs.open_output_stream(own, compression=None)
                writer, encode = Writer(out, frame_tokens), encoder(tokenizer).encode
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                writer.add(doc_id, encode(text) + end)
        if writer is not None:
            writer.close()
            out.close()
            if fs.get_file_info(f"{root}/{name}").type != pafs.FileType.NotFound:  # of an earlier attempt; not all stores replace
                fs.delete_file(f"{root}/{name}")
            fs.move(own, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([len(writer.frames)], pa.int32()), pa.array([writer.documents], pa.int64()), pa.array([writer.tokens], pa.int64())], names=["part", "file", "frames", "documents", "tokens"])

    return run


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, frame_tokens: int = FRAME_TOKENS) -> DataFrame:
    """Write the files; returns the manifest, one row a file: part, file, frames, documents, tokens, start (the tokens
    of all files before it)."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranged = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(shuffle_partitions(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    manifest = stored(ranged.mapInArrow(_written(folder, tokenizer, end_id, frame_tokens), _MANIFEST), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _read_back(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{root}/{row['file']}") as source:
                    reader = Reader(source)
                    for k in range(row["first"], min(row["first"] + row["step"], row["frames"])):
                        ids, starts, tokens = zip(*reader.frame(k), strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.array(starts) + row["start"]), pa.array(tokens, pa.binary())], names=["doc_id", "start", "ids"])

    return run


def read(manifest: DataFrame, folder: str, frames_a_task: int = 64) -> DataFrame:
    """Every document of the files: doc_id, start (tokens of all documents before it), ids."""
    spark = manifest.sparkSession
    ship(spark)
    step = F.lit(frames_a_task)
    spans = manifest.select("file", "frames", "start", step.alias("step"), F.explode(F.sequence(F.lit(0), F.col("frames") - 1, step)).alias("first"))
    return spans.repartition(shuffle_partitions(spark), "file", "first").mapInArrow(_read_back(folder), "doc_id long, start long, ids binary")


def lookup(spark: SparkSession, manifest: DataFrame, folder: str, doc_ids: list[int]) -> DataFrame:
    """The requested documents only: each file's tables tell which frames to decompress."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{root}/{row['file']}") as source:
                    found = list(Reader(source).documents(doc_ids))
                if found:
                    ids, starts, tokens = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.array(starts) + row["start"]), pa.array(tokens, pa.binary())], names=["doc_id", "start", "ids"])

    return manifest.mapInArrow(run, "doc_id long, start long, ids binary")


def report(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    back = read(write(docs, folder, tokenizer), folder)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
