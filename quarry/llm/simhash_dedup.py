"""Near duplicates by SimHash: exact comparison of all fingerprints in tiles.

Fingerprints of 64 bits are dealt into tiles by the population counts of their four 16-bit quarters. Two
fingerprints that differ in at most ``radius`` bits have counts whose differences add up to at most ``radius``, so
tiles further apart are skipped; every other pair of tiles is compared in full with numpy's exclusive-or and bit
counts. A tile's rows are homes;
each fingerprint also visits, as a guest, the tiles within the radius that come after its own in a fixed half of the
directions, so that every pair meets once. Which tiles hold anything is a table of at most 17**4 counts. Tiles beyond
``tile_rows`` homes are cut into blocks, and each fingerprint visits every block. Fingerprints travel packed, all of
one task that go the same way in one row. A visit of eight bytes pays for ``tile_rows`` comparisons at most: what is
shuffled is 65 fingerprints for each until tiles are cut, and from then on a ``tile_rows``-th of the comparisons. A
task never lists all pairs of a dense group: it keeps a union-find over the homes and passes on one link for each
linked row. Components come from alternating large-star and small-star rounds, each written to the shared folder; a
round's table is removed when its successor is written.

Equal texts have one fingerprint and are compared once.

Cases: a null text counts as empty; texts without a word have fingerprint zero and link like any other; texts of one
or two words have one shingle, the whole sequence; a null doc_id never names a component unless it has no other;
doc_id may be of any type that has an order; rows that share a doc_id get a row each, and :func:`drop_near_copies`
tells them apart, as it goes by row and not by doc_id: of each component, those of null doc_ids included, exactly one
row stays; very long texts are read whole; an empty table gives an empty result; extra columns, whatever their names,
come out of :func:`drop_near_copies` as they went in and are ignored by :func:`near_duplicates`.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.runtime import in_slices, numbered, remove, ship, shuffle_partitions, stored, stored_at

SEED = 42
RADIUS = 3
SHINGLE = 3
TILE_ROWS = 1 << 16
SIDE = 17  # a quarter has 0 to 16 bits set
CELLS = 1 << 21
BLOCK = 1 << 15
HELD = 1 << 17  # fingerprints that a task packs at once
SALTS = 16


def _hashes(words: list[bytes]) -> np.ndarray:
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED)), dtype=np.uint64, count=len(words) - SHINGLE + 1)


def fingerprint(text: str | None) -> int:
    """Bit b is set where more than half of the shingles' hashes have it set; unsigned."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = _hashes(words)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), BLOCK):
        part = np.ascontiguousarray(h[at : at + BLOCK].astype("<u8"))
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        found = np.fromiter((fingerprint(t) for t in batch.column("text").to_pylist()), dtype=np.uint64, count=batch.num_rows)
        kept = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(found.view(np.int64))], names=[*kept, "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, ``row`` if there is one, and ``fp``, the fingerprint as a signed 64-bit number, in place of the text."""
    ship(docs.sparkSession)
    schema = T.StructType([*(f for f in docs.schema if f.name != "text"), T.StructField("fp", T.LongType())])
    return docs.mapInArrow(_signed, schema)


def directions(radius: int = RADIUS) -> np.ndarray:
    """The half of all count differences within the radius whose first nonzero member is positive."""
    steps = range(-radius, radius + 1)
    near = [d for d in itertools.product(steps, repeat=4) if 0 < sum(map(abs, d)) <= radius]
    return np.array([d for d in near if next(x for x in d if x) > 0], dtype=np.int64).reshape(-1, 4)


def quarter_counts(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(fps).view(np.uint16).reshape(-1, 4)).astype(np.int64)


def tile_of(counts: np.ndarray) -> np.ndarray:
    return ((counts[:, 0] * SIDE + counts[:, 1]) * SIDE + counts[:, 2]) * SIDE + counts[:, 3]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SIDE**4, dtype=np.int64)
    for batch in batches:
        total += np.bincount(tile_of(quarter_counts(batch.column("fp").to_numpy(zero_copy_only=False))), minlength=SIDE**4)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"tile": pa.array(at.astype(np.int32)), "n": pa.array(total[at])})


def _dealt(blocks_of, radius: int):
    """Rows (tile, block, guest, fps): homes, and guests for each block that they must meet, packed by where they go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, steps = blocks_of.value, directions(radius)
        held: list[np.ndarray] = []

        def packed(fps: np.ndarray) -> Iterator[tuple[int, int, bool, bytes]]:
            counts = quarter_counts(fps)
            home = tile_of(counts)
            own = (fps.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks[home]
            order = np.lexsort((own, home))
            fps, counts, home, own = fps[order], counts[order], home[order], own[order]
            first = np.flatnonzero(np.r_[True, (np.diff(home) != 0) | (np.diff(own) != 0)])
            for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(fps)], strict=True):
                body, tile, block = fps[lo:hi].tobytes(), int(home[lo]), int(own[lo])
                yield tile, block, False, body
                for later in range(block + 1, int(blocks[tile])):  # a tile in blocks: later blocks of the own tile, too
                    yield tile, later, True, body
                there = counts[lo] + steps
                there = tile_of(there[((there >= 0) & (there < SIDE)).all(axis=1)])
                for other in there[blocks[there] > 0].tolist():
                    for at in range(int(blocks[other])):
                        yield other, at, True, body

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            rows = packed(np.concatenate(held))
            held.clear()
            while part := list(itertools.islice(rows, 4096)):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), (pa.int32(), pa.int32(), pa.bool_(), pa.binary()), strict=True)], names=["tile", "block", "guest", "fps"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64))
                if sum(map(len, held)) >= HELD:
                    yield from flush()
        yield from flush()

    return run


class _Links:
    """Union-find over the homes of a block, on whole arrays."""

    def __init__(self, size: int):
        self.parent = np.arange(size)
        self.linked = np.zeros(size, dtype=bool)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        parent = self.parent
        self.linked[a] = True
        self.linked[b] = True
        while True:
            a, b = parent[a], parent[b]
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := parent[parent], parent):
                parent[:] = up


def _compare(radius: int):
    """Rows come sorted by tile, block, guest. Yields links (a, b) between fingerprints that keep all that is connected connected."""

    def near(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        rows = max(1, CELLS // max(1, len(b)))
        for at in range(0, len(a), rows):
            i, j = np.nonzero(np.bitwise_count(a[at : at + rows, None] ^ b[None, :]) <= radius)
            if len(i):
                yield at, i, j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, homes, links = None, [], None, None

        def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

        def settle() -> None:
            nonlocal homes, links
            if homes is None:
                homes = np.concatenate(waiting) if waiting else np.zeros(0, dtype=np.uint64)
                waiting.clear()
                links = _Links(len(homes))
                for at, i, j in near(homes, homes):
                    later = j > i + at
                    if later.any():
                        links.add(i[later] + at, j[later])

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal homes, links
            if key is not None:
                settle()
                own = np.flatnonzero(links.parent != np.arange(len(homes)))
                if len(own):
                    yield out(homes[own], homes[links.parent[own]])
            homes, links = None, None

        for batch in batches:
            for tile, block, guest, body in zip(*(batch.column(n).to_pylist() for n in ("tile", "block", "guest", "fps")), strict=True):
                if (tile, block) != key:
                    yield from close()
                    key = tile, block
                part = np.frombuffer(body, dtype=np.uint64)
                if not guest:
                    waiting.append(part)
                    continue
                settle()
                for at, i, j in near(part, homes):
                    first = np.flatnonzero(np.r_[True, np.diff(i) != 0])
                    head = j[np.repeat(first, np.diff(np.r_[first, len(i)]))]
                    links.add(head, j)
                    yield out(part[i[first] + at], homes[j[first]])
        yield from close()

    return run


def links(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (a, b) over a frame of distinct fingerprints ``fp`` that span every component."""
    spark = fps.sparkSession
    ship(spark)
    counts = fps.mapInArrow(_tiles, "tile int, n long").groupBy("tile").agg(F.sum("n").alias("n")).collect()  # at most 17**4 rows
    blocks = np.zeros(SIDE**4, dtype=np.int64)
    for row in counts:
        blocks[row["tile"]] = -(-row["n"] // tile_rows)
    dealt = fps.mapInArrow(_dealt(spark.sparkContext.broadcast(blocks), radius), "tile int, block int, guest boolean, fps binary")
    dealt = dealt.repartition(shuffle_partitions(spark), "tile", "block").sortWithinPartitions("tile", "block", "guest")
    return dealt.mapInArrow(_compare(radius), "a long, b long")


def _spread_join(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``table``, whose keys are unique. A key that many rows share, as the centre of a
    star is, is dealt over several tasks."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    return salted.join(copies.hint("merge"), [key, "_salt"]).drop("_salt")  # never broadcast: the copies outgrow their estimate


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that is not its component's smallest."""
    turned = lambda e: e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()

    def mark(e: DataFrame) -> tuple:
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()

    now, path = stored_at(turned(edges), "links")
    before = mark(now)
    while before[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = turned(_spread_join(both, least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _spread_join(large, least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least)
        last = path
        now, path = stored_at(turned(small), "links")
        after = mark(now)
        remove(now.sparkSession, last)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _classes(signed: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """``fp`` and ``component_id`` for every distinct fingerprint of a stored frame of doc_id and fp."""
    distinct = signed.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    distinct = stored(distinct, "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), radius, tile_rows))
    linked = roots.union(roots.select(F.col("root"), F.col("root")).distinct()).select(F.col("node").alias("fp"), "root")
    named = linked.join(distinct, "fp")
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = _spread_join(named, smallest, "root").select("fp", "root", "component_id")
    by_fp = distinct.join(named, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first_id").alias("component_id"))
    return stored(by_fp, "components")  # so that both sides of a join are dealt anew, and a large group is split


def near_duplicates(docs: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id (smallest doc_id reachable)."""
    signed = stored(fingerprints(docs.select("doc_id", "text")), "fingerprints")
    by_fp = _classes(signed, radius, tile_rows)
    return signed.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id, of several the first as they came."""
    keyed = stored(numbered(docs).withColumn("row", F.monotonically_increasing_id()), "near-rows")
    signed = stored(fingerprints(keyed.select("doc_id", "row", "text")), "fingerprints")
    by_fp = _classes(signed, radius, tile_rows).select("fp", "root")
    placed = stored(signed.join(by_fp, "fp").select("row", "root", "doc_id"), "near-places")
    best = placed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("n"))
    best = best.where("n > 1").select("root", F.col("best.row").alias("stays"))
    gone = _spread_join(placed.select("row", "root"), best, "root").where("row != stays").select("row")
    return keyed.join(stored(gone, "near-gone"), "row", "left_anti").drop("row").toDF(*docs.columns)
