"""Packing documents into token sequences by vector best-fit.

A document's ids end with a separator. Documents longer than a sequence are cut into whole sequences, the rest
coming first; every piece is an item with three demands: tokens, one document, and attention cost (length squared).
A sequence has a capacity for each. Items are placed by decreasing length; among the open sequences that can take an
item under every capacity, the one with the smallest weighted norm of what is left (``norm``) or the largest weighted
dot product of demand and residual (``dot``) is chosen, and a new one is opened if none can.

Each task packs windows of ``window_tokens`` tokens, so memory is bounded and nothing is shuffled; a window leaves
about one sequence that is not full. A sequence takes at most ``documents`` pieces; a window that needs more sequences
for that than its tokens alone do is packed again with that capacity given up (``spare``), so that it never costs a
sequence. The attention capacity cannot be less than a full piece's own cost, and the costs of pieces that share a
sequence add up to less than that; it takes part in the choice, and binds where ``attention`` is set lower for
shorter pieces.

Cases: a null or empty text is a document of one token, the separator; repeated rows are packed each; a null doc_id
stays null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.tokens import encoder
from quarry.runtime import give_back, ship

IN_ROWS = 64  # texts that are Python strings at once
OUT_ROWS = 256
SCHEMA = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"


@dataclass(frozen=True)
class Packing:
    tokenizer: str
    end_id: int = 0
    tokens: int = 2048
    documents: int = 64
    attention: int = 2048 * 2048
    choose: str = "norm"
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    window_tokens: int = 1 << 24
    spare: bool = True


def pieces(length: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    first = length % most
    starts = range(first, length, most)
    return ([(0, first)] if first else []) + [(s, most) for s in starts]


def best_fit(lengths: np.ndarray, p: Packing) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of every item; sequences are numbered from zero."""
    capacity = np.array([p.tokens, p.documents, p.attention], dtype=np.float64)
    weights = np.array(p.weights)
    if (lengths > p.tokens).any() or (lengths.astype(np.float64) ** 2 > p.attention).any() or p.documents < 1:
        raise ValueError("an item exceeds a sequence's capacity")
    sequence, offset = np.empty(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths.min()) if len(lengths) else 0
    demand = np.stack([lengths, np.ones(len(lengths)), lengths.astype(np.float64) ** 2], axis=1)
    residual = np.empty((1024, 3))  # of open sequences, as shares of the capacity where scores are made
    number = np.empty(1024, dtype=np.int64)
    used, opened = 0, 0
    for i in order:
        d = demand[i]
        at = -1
        if used:
            left = residual[:used] - d
            if p.choose == "norm":
                score = np.square(left / capacity) @ weights
            else:
                score = -((residual[:used] / capacity) * (d / capacity)) @ weights
            score[(left < 0).any(axis=1)] = np.inf
            at = int(score.argmin())
            if score[at] == np.inf:
                at = -1
        if at < 0:
            if used == len(residual):
                residual, number = np.concatenate([residual, np.empty_like(residual)]), np.concatenate([number, np.empty_like(number)])
            at, used = used, used + 1
            residual[at], number[at] = capacity, opened
            opened += 1
        sequence[i], offset[i] = number[at], p.tokens - int(residual[at, 0])
        residual[at] -= d
        if residual[at, 0] < least or residual[at, 1] < 1:  # nothing fits any more
            used -= 1
            residual[at], number[at] = residual[used], number[used]
    return sequence, offset


def fewest(lengths: np.ndarray, p: Packing) -> tuple[np.ndarray, np.ndarray]:
    """:func:`best_fit`, without the document capacity where that saves sequences and ``spare`` allows it."""
    found = best_fit(lengths, p)
    if p.spare and len(lengths) and found[0].max() + 1 > -(-int(lengths.sum()) // p.tokens):
        other = best_fit(lengths, replace(p, documents=p.tokens))
        return other if other[0].max() < found[0].max() else found
    return found


def _packed(p: Packing):
    end = np.array([p.end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(p.tokenizer).encode
        first = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            """The window's rows a few at a time, so that no second copy of its ids is made."""
            nonlocal first, tokens
            if not rows:
                return
            sequence, offset = fewest(np.array([r[3] for r in rows], dtype=np.int64), p)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            for at in range(0, len(rows), OUT_ROWS):
                to = at + OUT_ROWS
                columns = zip(*rows[at:to], strict=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), pa.array(sequence[at:to] + first), pa.array(offset[at:to])], names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])
            first += int(sequence.max()) + 1
            tokens = 0
            rows.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, IN_ROWS):
                part = batch.slice(at, IN_ROWS)
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = encode(text) + end
                    for k, (start, length) in enumerate(pieces(len(ids) // 4, p.tokens)):
                        rows.append((doc_id, k, start, length, ids[4 * start : 4 * (start + length)]))
                    tokens += len(ids) // 4
                    if tokens >= p.window_tokens:
                        yield from flush()
        yield from flush()
        batch = part = ids = None  # noqa: F841 - these hold the last rows
        give_back()

    return run


def pack(docs: DataFrame, packing: Packing) -> DataFrame:
    """One row per piece with its ids (little-endian unsigned 32-bit integers), sequence and offset."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_packed(packing), SCHEMA)


def report(docs: DataFrame, packing: Packing) -> DataFrame:
    return pack(docs, packing).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
