"""Exact deduplication behind a two-pass Bloom filter.

Pass one sets, for the hash of every text, four positions of a bit table and marks those that a second row also
sets. Pass two looks every hash up: only where all four positions were set twice can the text occur again. Those
rows alone are shuffled and grouped; the rest pass straight through. The table has about 16 bits a row and never
more than ``max_bits``, so that what is broadcast stays bounded; beyond that more rows are shuffled in vain, and
the result is the same.

Texts are equal when they are identical after ``[\\x20\\x09-\\x0D]`` is deleted. Of equal texts the row with the most
code points stays, then the one with the smallest doc_id.

Cases: a null text counts as empty, so null, empty and blank texts form one group; a null doc_id sorts behind all
others; of rows that share a doc_id and a length the first text in code-point order stays, and of rows that are equal
in everything exactly one; doc_id may be of any type that has an order; very long texts are hashed whole; an empty
table gives an empty result; extra columns, whatever their names, come out of :func:`drop_copies` as they went in and
are ignored by :func:`duplicates`.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.runtime import in_slices, numbered, ship, shuffle_partitions, stored

SPACES = " \t\n\x0b\x0c\r"
BITS_PER_ROW = 16
RANGE_ROWS = 1 << 25  # rows of a hash range: a table of 64 to 128 MB
SEGMENT = 1 << 17  # bits that one row of a partial table covers
FLUSH = 1 << 21


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def text_hash(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, lowercase hexadecimal."""
    return F.sha2(normalised(text).cast("binary"), 256)


def table_bits(rows: int, bits_per_row: int = BITS_PER_ROW) -> int:
    """A power of two: at least ``bits_per_row`` for each row, and at least 2**16."""
    return 1 << (max(1 << 16, rows * bits_per_row) - 1).bit_length()


def positions(hashes: pa.Array, bits: int) -> np.ndarray:
    """Four positions for each hexadecimal hash, as rows; from its second half, as ranges share the beginning."""
    text = np.frombuffer("".join(h[32:] for h in hashes.to_pylist()).encode(), dtype=np.uint8)
    digits = np.where(text >= 97, text - 87, text - 48).astype(np.uint8).reshape(-1, 16, 2)
    raw = (digits[:, :, 0] << 4 | digits[:, :, 1]).astype(np.uint8)
    return np.ascontiguousarray(raw).view("<u4").reshape(-1, 4) & np.uint32(bits - 1)


def _partial(bits: int):
    """Of one partition: for each segment the positions set, and those set by two rows or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            segments = found // SEGMENT
            cuts = np.flatnonzero(np.diff(segments)) + 1
            for at, n in zip(np.split(found, cuts), np.split(counts, cuts), strict=True):
                inner = (at % SEGMENT).astype("<u4")
                yield pa.RecordBatch.from_pydict(
                    {"segment": pa.array([int(at[0]) // SEGMENT], pa.int32()), "once": pa.array([inner.tobytes()], pa.binary()), "twice": pa.array([inner[n > 1].tobytes()], pa.binary())}
                )

        for batch in batches:
            if batch.num_rows:
                rows = np.sort(positions(batch.column(0), bits), axis=1)
                first = np.ones(rows.shape, dtype=bool)  # a position that one row sets twice counts once
                first[:, 1:] = rows[:, 1:] != rows[:, :-1]
                held.append(rows[first])
                if sum(map(len, held)) >= FLUSH:
                    yield from flush()
        yield from flush()

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by segment; one bit table of a segment is held at a time."""
    segment, once, twice = None, None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.int32()), "twice": pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())})

    for batch in batches:
        for s, a, b in zip(*(batch.column(n).to_pylist() for n in ("segment", "once", "twice")), strict=True):
            if s != segment:
                if segment is not None and twice.any():
                    yield done()
                segment, once, twice = s, np.zeros(SEGMENT, dtype=bool), np.zeros(SEGMENT, dtype=bool)
            at = np.frombuffer(a, dtype="<u4")
            twice[at[once[at]]] = True
            once[at] = True
            twice[np.frombuffer(b, dtype="<u4")] = True
    if segment is not None and twice.any():
        yield done()


def repeated_bits(hashes: DataFrame, bits: int) -> bytes:
    """Pass one over a frame whose first column holds the hashes: the table of positions that two rows set."""
    spark = hashes.sparkSession
    parts = hashes.mapInArrow(_partial(bits), "segment int, once binary, twice binary")
    dealt = parts.repartition(shuffle_partitions(spark), "segment").sortWithinPartitions("segment")
    table = bytearray(max(bits, SEGMENT) // 8)
    for row in dealt.mapInArrow(_merged, "segment int, twice binary").toLocalIterator():  # at most bits / 8 bytes in all
        at = row["segment"] * (SEGMENT // 8)
        table[at : at + SEGMENT // 8] = row["twice"]
    return bytes(table)


def _looked_up(table, bits: int, column: str, wanted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(table.value, dtype=np.uint8)
        for batch in in_slices(batches):
            at = positions(batch.column(column), bits)
            maybe = ((twice[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
            yield batch.filter(pa.array(maybe if wanted else ~maybe))

    return run


def hash_ranges(rows: int, range_rows: int) -> list[tuple[str, str | None]]:
    """(least hash, first hash beyond) of ranges of about ``range_rows`` rows each; the last has no end."""
    n = max(1, -(-rows // range_rows))
    starts = [f"{k * (1 << 32) // n:08x}" for k in range(n)]
    return list(zip(starts, [*starts[1:], None], strict=True))


def split_by_filter(rows: DataFrame, column: str, range_rows: int = RANGE_ROWS, bits_per_row: int = BITS_PER_ROW) -> tuple[DataFrame, DataFrame]:
    """(rows whose hash may repeat, rows whose hash is unique for certain) of a stored frame."""
    spark = rows.sparkSession
    ship(spark)
    found: list[tuple[DataFrame, DataFrame]] = []
    n = rows.count()
    ranges = hash_ranges(n, range_rows)
    bits = table_bits(-(-n // len(ranges)), bits_per_row)
    of = F.col(column)
    for least, beyond in ranges:
        own = rows
        if len(ranges) > 1:
            own = own.where(of >= least)
            own = own if beyond is None else own.where(of < beyond)
        table = spark.sparkContext.broadcast(repeated_bits(own.select(of), bits))
        found.append(tuple(own.mapInArrow(_looked_up(table, bits, column, wanted), rows.schema) for wanted in (True, False)))
    return tuple(functools.reduce(DataFrame.unionAll, part) for part in zip(*found, strict=True))


def duplicates(docs: DataFrame, range_rows: int = RANGE_ROWS, bits_per_row: int = BITS_PER_ROW) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    thin = docs.select("doc_id", text_hash(F.col("text")).alias("text_sha256"), F.length(F.coalesce(F.col("text"), F.lit(""))).alias("chars"))
    thin = stored(thin.withColumn("row", F.monotonically_increasing_id()).sortWithinPartitions("text_sha256"), "dedup-hashes")
    maybe, single = split_by_filter(thin, "text_sha256", range_rows, bits_per_row)
    rank = F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    groups = maybe.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"), F.min(rank).alias("best"))
    groups = groups.select("text_sha256", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    groups = stored(groups, "dedup-groups")  # so that both sides of the join are dealt anew, and a large group is split
    repeated = maybe.join(groups, "text_sha256").select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")
    alone = single.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    return alone.unionByName(repeated)


def drop_copies(docs: DataFrame, range_rows: int = RANGE_ROWS, bits_per_row: int = BITS_PER_ROW) -> DataFrame:
    """``docs`` without the rows that do not stay; the texts of rows that the filter lets through are not shuffled."""
    inner = numbered(docs)
    hashed = stored(inner.withColumn("hash", text_hash(F.col("text"))).sortWithinPartitions("hash"), "dedup-hashed")
    maybe, single = split_by_filter(hashed, "hash", range_rows, bits_per_row)
    rank = F.struct(-F.length(F.coalesce(F.col("text"), F.lit(""))), F.col("doc_id").isNull(), F.col("doc_id"), F.col("text"))
    best = maybe.groupBy("hash").agg(F.min_by(F.struct(*inner.columns), rank).alias("row")).select("row.*")
    return single.select(*inner.columns).unionByName(best).toDF(*docs.columns)
