import types

import numpy as np
import pyarrow as pa

from quarry.llm import packing


def test_packing_holds_a_window_once(monkeypatch):
    ids = [np.full(2040 + i % 7, i, dtype="<u4").tobytes() for i in range(3000)]
    monkeypatch.setattr(packing, "encoder", lambda _: types.SimpleNamespace(encode=lambda text: ids[int(text)]))
    monkeypatch.setattr(packing, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    run = packing._packed(packing.Packing(""))
    source = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(3000), pa.int64()), "text": pa.array(map(str, range(3000)))})
    before, most, got = pa.total_allocated_bytes(), 0, []
    for out in run(iter([source])):
        most = max(most, pa.total_allocated_bytes() - before)
        got += [(d, k, i) for d, k, i in zip(*(out.column(n).to_pylist() for n in ("doc_id", "piece", "ids")), strict=True)]
    assert got == [(i, 0, x + bytes(4)) for i, x in enumerate(ids)]
    assert most < sum(map(len, ids)) / 2
