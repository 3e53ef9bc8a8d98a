import types

import numpy as np
import pyarrow as pa

from quarry.llm import exact_dedup, secret_scan, simhash_dedup

ROWS = 4000
TEXT = "some words of a text " * 200


def peak(run, source):
    """All rows that came out and the most Arrow memory that they took at once."""
    before, most, got = pa.total_allocated_bytes(), 0, []
    for out in run(iter([source])):
        most = max(most, pa.total_allocated_bytes() - before)
        assert out.num_rows <= 256
        got += out.to_pylist()
    return got, most


def test_stages_copy_few_texts_at_once():
    texts = [f"{i} {TEXT}" for i in range(ROWS)]
    spans = [[{"start": 0, "kind": 2, "end": 1}] if i % 2 else [] for i in range(ROWS)]
    source = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(ROWS)), "text": pa.array(texts), "spans": pa.array(spans, secret_scan._ARROW_SPAN)})
    got, most = peak(secret_scan._masked(["doc_id", "text"]), source)
    assert got == [{"doc_id": i, "text": f"[{secret_scan.KINDS[2]}]{t[1:]}" if i % 2 else t} for i, t in enumerate(texts)]
    assert most < source.nbytes / 4

    hashes = [f"{i:064x}" for i in range(ROWS)]
    source = pa.RecordBatch.from_pydict({"hash": pa.array(hashes), "text": pa.array(texts)})
    bits = exact_dedup.table_bits(ROWS, 16)
    table = types.SimpleNamespace(value=np.zeros(bits // 8, dtype=np.uint8).tobytes())
    got, most = peak(exact_dedup._looked_up(table, bits, "hash", False), source)
    assert [r["hash"] for r in got] == hashes and most < source.nbytes / 4
    assert not peak(exact_dedup._looked_up(table, bits, "hash", True), source)[0]

    source = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(ROWS)), "text": pa.array(texts)})
    got, _ = peak(simhash_dedup._signed, source)
    assert [r["fp"] % (1 << 64) for r in got[::500]] == [simhash_dedup.fingerprint(t) for t in texts[::500]]
    got, _ = peak(secret_scan._found(["doc_id"]), source)
    assert [r["doc_id"] for r in got] == list(range(ROWS))
