"""Byte-level BPE over a whole corpus by a global shuffle of distinct words, and its decoding.

1. *Pre-tokens with positions.* Documents are taken in blocks of about ``block_bytes`` of text and split once. A
   block's distinct pre-tokens are numbered by frequency, and each document becomes the sequence of its pre-tokens'
   numbers: that is the list of positions of every word, at one or two bytes each.
2. *Distinct words.* The block's words are dealt by hash into buckets; there are as many as shuffle partitions, and on
   small clusters up to ``MOST_BUCKETS`` by the input's size. Words travel once a block, compressed. The task of a
   bucket meets each of its words from all blocks and encodes it once; what it keeps is one bucket's distinct words.
3. *Joining back.* The ids of a block's words return to the block and are put into their positions.

Decoding joins ids with the table of the vocabulary's bytes, whose size is fixed.

Words and positions come of one pass over the input, and both carry a hash of the block's texts. A frame that is more
than a scan, a filter and a projection may come in another order if a lost task is run again; it is stored first.

Cases: a null or empty text has no ids and decodes to nothing; repeated rows are encoded each (their words once); a
very long text is a block of its own; a null doc_id stays null; an empty table gives an empty result; extra columns
are ignored; code points that the two regex engines may class differently stay within their stretch between
single blanks that part any text, which counts as one word and is split by the library's own engine (with another pattern than the known one the
whole text does).
"""

from __future__ import annotations

import base64
import functools
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.runtime import ship, shuffle_partitions, stored

BLOCK_BYTES = 12 << 20
BUCKET_BYTES, MOST_BUCKETS = 1 << 21, 1024

#: Fixed value: the pattern for which the cut at :data:`_SURE` is proven. No match holds a blank behind another character.
CUTTABLE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A single blank between two ASCII letters or digits parts any text.
_SURE = re.compile("(?<=[A-Za-z0-9])(?= [A-Za-z0-9])")


@functools.cache
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.cache
def encoding(ranks: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("quarry", pat_str=pattern, mergeable_ranks=read_ranks(ranks), special_tokens={})


@functools.cache
def token_bytes(ranks: str) -> list[bytes]:
    table = read_ranks(ranks)
    out = [b""] * (max(table.values()) + 1)
    for token, rank in table.items():
        out[rank] = token
    return out


@functools.cache
def _splitter(pattern: str):
    import regex

    return regex.compile(pattern)


@functools.cache
def _newer() -> object:
    """Code points that this Python's tables do not know: the two regex engines may class them differently."""
    import regex

    lone = [cp for cp in range(0x530, 0x110000) if unicodedata.category(chr(cp)) == "Cn"]
    cuts = np.flatnonzero(np.diff(lone) != 1)
    starts, ends = np.r_[0, cuts + 1], np.r_[cuts, len(lone) - 1]
    return regex.compile("[" + "".join(f"\\U{lone[a]:08x}-\\U{lone[b]:08x}" for a, b in zip(starts, ends, strict=True)) + "]")


def _unsure(text: str) -> bool:
    return not text.isascii() and max(text) > "\u052f" and bool(_newer().search(text))


def pre_tokens(text: str, pattern: str) -> list[str]:
    """The matches of the pattern; a stretch with code points that the engines may class differently counts as one."""
    if not _unsure(text):
        return _splitter(pattern).findall(text)
    if pattern != CUTTABLE:
        return [text]
    return [w for part in _SURE.split(text) for w in ([part] if _unsure(part) else _splitter(pattern).findall(part))]


def _squeeze(raw: bytes | memoryview) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _loose(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def _numbers(values: np.ndarray) -> bytes:
    """Compressed by byte planes: the high bytes of small numbers cost next to nothing."""
    return _squeeze(np.ascontiguousarray(values.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T).reshape(-1).data)


def _numbers_of(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(_loose(raw), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class _Numbering(dict):
    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[list, list[str]]]:
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                text = text or ""
                ids.append(doc_id)
                texts.append(text)
                size += len(text) + 32
                if size >= block_bytes:
                    yield ids, texts
                    ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


_SCHEMA = "dest int, block string, bucket int, words binary, docs binary, lengths binary, doc_ids array<long>, of_bucket binary, counts binary, ids binary"
_ARROW = pa.schema([
    ("dest", pa.int32()), ("block", pa.string()), ("bucket", pa.int32()), ("words", pa.binary()), ("docs", pa.binary()), ("lengths", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("of_bucket", pa.binary()), ("counts", pa.binary()), ("ids", pa.binary()),
])


def _split(pattern: str, buckets: int, block_bytes: int):
    """For each block a row with its documents (bucket -1), and a row for each bucket with its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, (doc_ids, texts) in enumerate(_blocks(batches, block_bytes)):
            number, mark = _Numbering(), xxhash.xxh3_64()
            sequence, lengths = array("I"), []
            for text in texts:
                found = pre_tokens(text, pattern)
                sequence.extend(map(number.__getitem__, found))
                lengths.append(len(found))
                mark.update(text.encode())
                mark.update(b"\xff")
            texts.clear()
            block = f"{part}-{k}-{mark.hexdigest()}"
            places = np.frombuffer(sequence, dtype=np.uint32) if sequence else np.zeros(0, dtype=np.uint32)
            order = np.argsort(-np.bincount(places, minlength=len(number)), kind="stable")
            unordered = list(number)
            number.clear()
            words = [unordered[i] for i in order.tolist()]
            del unordered
            of_bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words), dtype=np.uint32, count=len(words))
            rank = np.empty(len(order), dtype=np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            row = {"dest": mark.intdigest() % buckets, "block": block, "bucket": -1, "docs": _numbers(rank[places] if len(rank) else places), "lengths": _numbers(np.array(lengths)), "doc_ids": doc_ids, "of_bucket": _numbers(of_bucket)}
            yield pa.RecordBatch.from_pylist([row], schema=_ARROW)
            del row, places, sequence, rank
            by = np.argsort(of_bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(of_bucket[by])) + 1
            rows = []
            for group in np.split(by, cuts) if len(by) else []:
                own = [words[i].encode() for i in group.tolist()]
                sizes = np.fromiter(map(len, own), dtype="<u4", count=len(own))
                bucket = int(of_bucket[group[0]])
                rows.append({"dest": bucket, "block": block, "bucket": bucket, "words": _squeeze(np.array([len(own)], dtype="<u4").tobytes() + sizes.tobytes() + b"".join(own))})
                if len(rows) == 64:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return run


def _sized(raw: bytes) -> tuple[np.ndarray, bytes]:
    loose = _loose(raw)
    n = int(np.frombuffer(loose[:4], dtype="<u4")[0])
    return np.frombuffer(loose[4 : 4 + 4 * n], dtype="<u4"), loose[4 + 4 * n :]


def _encoded(ranks: str, pattern: str):
    """Rows come sorted by bucket. Documents pass; of a bucket's words, from every block, each distinct one is encoded
    once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(ranks, pattern).encode_ordinary

        class Known(dict):
            def __missing__(self, word: bytes) -> bytes:
                self[word] = ids = np.array(encode(word.decode()), dtype="<u4").tobytes()
                return ids

        known, of = Known(), None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["bucket"] >= 0:
                    if row["bucket"] != of:
                        known, of = Known(), row["bucket"]
                    sizes, body = _sized(row["words"])
                    ends = np.cumsum(sizes).tolist()
                    ids = [known[body[a:b]] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                    row |= {"words": None, "counts": _numbers(np.fromiter(map(len, ids), dtype="<u4", count=len(ids)) // 4), "ids": _numbers(np.frombuffer(b"".join(ids), dtype="<u4"))}
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block and bucket, the block's documents (bucket -1) first."""
    head, parts = None, []

    def close() -> Iterator[pa.RecordBatch]:
        of_bucket = _numbers_of(head["of_bucket"])
        if [b for b, _, _ in parts] != np.unique(of_bucket).tolist():
            raise RuntimeError(f"words of block {head['block']} are missing: a lost task read its rows in another order")
        by = np.argsort(of_bucket, kind="stable")
        counts = np.concatenate([c for _, c, _ in parts]) if parts else np.zeros(0, dtype=np.uint32)
        ids = np.concatenate([i for _, _, i in parts]) if parts else np.zeros(0, dtype=np.uint32)
        ends = np.cumsum(counts, dtype=np.int64)
        raw = ids.astype("<u4").tobytes()
        of_word = [b""] * len(by)
        for word, a, b in zip(by.tolist(), (ends - counts).tolist(), ends.tolist(), strict=True):
            of_word[word] = raw[4 * a : 4 * b]
        places = _numbers_of(head["docs"])
        lengths = _numbers_of(head["lengths"]).tolist()
        at = 0
        for lo in range(0, len(lengths), 512):
            out = []
            for n in lengths[lo : lo + 512]:
                out.append(b"".join(map(of_word.__getitem__, places[at : at + n].tolist())))
                at += n
            yield pa.RecordBatch.from_arrays([pa.array(head["doc_ids"][lo : lo + 512], pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "ids"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] < 0:
                if head is not None:
                    yield from close()
                head, parts = row, []
            elif head is None or row["block"] != head["block"]:
                raise RuntimeError(f"documents of block {row['block']} are missing: a lost task read its rows in another order")
            else:
                parts.append((row["bucket"], _numbers_of(row["counts"]), _numbers_of(row["ids"])))
    if head is not None:
        yield from close()


def _steady(docs: DataFrame) -> bool:
    """Whether the frame is no more than scans, filters and projections, which give rows in the same order each time."""
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    nodes = {m[1] for m in re.finditer(r"^[\s:+-]*([A-Z]\w+)", plan, re.M)}
    return nodes <= {"Project", "Filter", "Relation", "LocalRelation"}


def _buckets(docs: DataFrame) -> int:
    """Shuffle partitions, or more on small clusters: by the scan's size as Spark estimates it."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(shuffle_partitions(docs.sparkSession), min(MOST_BUCKETS, size // BUCKET_BYTES))


def encode(docs: DataFrame, ranks: str, pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id and ``ids``, little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    ship(spark)
    n = shuffle_partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows if _steady(docs) else stored(rows, "texts")
    both = rows.mapInArrow(_split(pattern, _buckets(rows), block_bytes), _SCHEMA)
    met = both.repartition(n, "dest").sortWithinPartitions("bucket").mapInArrow(_encoded(ranks, pattern), _SCHEMA).drop("dest", "words")
    dealt = met.repartition(n, "block").sortWithinPartitions("block", "bucket")
    return dealt.mapInArrow(_joined, "doc_id long, ids binary")


def _decoded(ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(ranks)
        for batch in batches:
            out = [None if ids is None else b"".join(map(table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return run


def decode(tokens: DataFrame, ranks: str) -> DataFrame:
    """``tokens`` with ``decoded``, the bytes that its ``ids`` stand for."""
    ship(tokens.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema)
    return tokens.mapInArrow(_decoded(ranks), f"{fields}, decoded binary")


def report(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    tokens = decode(encode(docs, ranks, pattern), ranks)
    return tokens.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
