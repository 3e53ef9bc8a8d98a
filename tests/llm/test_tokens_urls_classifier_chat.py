import hashlib
import io
import json
import random
import struct
import sys
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import plain
import public_tokenizers

from quarry.llm import byte_bpe, chat_format, quality_classifier, queries, token_files, url_filter

ODD = [
    (1, "Hello  world\n\n it's 12345!!"),
    (2, None),
    (3, ""),
    (4, "    "),
    (5, "a\u00a0b \u2003c \u0301d É \x1c x\u3000 y"),
    (6, "한국어 テキスト 🙂🙂 \U0001e6c0 \u0897 x\u088f \ua7ce"),
    (7, "word " * 5000),
    (8, "x" * 30000),
    (9, "\t\n \r\n  end  "),
    (10, "Hello  world\n\n it's 12345!!"),
    (11, "<|endoftext|> we'LL don't ǰ J\u030c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x", 3) for i, t in ODD], "doc_id long, text string, ids string, start int").repartition(3)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def _ranks():
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_byte_bpe(spark, sf, docs, odd):
    e = byte_bpe.encoding(_ranks(), public_tokenizers.PATTERN)

    def check(df, source):
        want = {}
        for i, t in source:
            ids = e.encode_ordinary(t or "")
            want[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        got = df.collect()
        assert {r[0]: tuple(r)[1:] for r in got} == want and len(got) == len(want)

    check(queries.op3_byte_bpe(spark, sf), docs)
    check(byte_bpe.report(odd, _ranks(), public_tokenizers.PATTERN), ODD)
    small = byte_bpe.encode(odd, _ranks(), public_tokenizers.PATTERN, block_bytes=100)
    assert {r["doc_id"]: len(r["ids"]) // 4 for r in small.collect()} == {i: len(e.encode_ordinary(t or "")) for i, t in ODD}
    assert byte_bpe.encode(odd.limit(0), _ranks(), public_tokenizers.PATTERN).count() == 0


def test_pre_tokens_agree_with_the_library_on_every_letter_and_space():
    e = byte_bpe.encoding(_ranks(), public_tokenizers.PATTERN)
    rng = random.Random(1)
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    for _ in range(150):
        text = "".join(chr(rng.choice(points)) + rng.choice(["", " ", "a", "1", "\n"]) for _ in range(300))
        assert [i for w in byte_bpe.pre_tokens(text, public_tokenizers.PATTERN) for i in e.encode_ordinary(w)] == e.encode_ordinary(text)


def test_unknown_code_points_keep_a_stretch_and_not_the_text_whole():
    assert byte_bpe.CUTTABLE == public_tokenizers.PATTERN
    text = "many words before " * 200 + "odd \u0378x! and" + " many words behind" * 200
    words = byte_bpe.pre_tokens(text, public_tokenizers.PATTERN)
    assert len(words) > 1200 and max(map(len, words)) < 12 and "".join(words) == text
    e = byte_bpe.encoding(_ranks(), public_tokenizers.PATTERN)
    rng = random.Random(2)
    parts = "the 'S 's don't I'LL we'd 12 a1! \u65e5\u672c \u01f0 e\u0301 \U0001f642 \U0001e6c0 \u0897 x\u088f \ua7ce a\u2026 \u0378x y\u0378 ab\x1c".split(" ")
    spaces = [" ", " ", "  ", "\n", "\n\n", " \n", "\t", "\xa0", "\u3000", "\x1c", ""]
    for _ in range(5000):
        x = "".join(rng.choice(spaces) + rng.choice(parts) for _ in range(rng.randint(0, 9))) + rng.choice(spaces)
        assert [i for w in byte_bpe.pre_tokens(x, public_tokenizers.PATTERN) for i in e.encode_ordinary(w)] == e.encode_ordinary(x), repr(x)


def test_each_distinct_word_is_encoded_once(monkeypatch):
    asked = []

    class Spy:
        def encode_ordinary(self, word):
            asked.append(word)
            return [len(asked)]

    monkeypatch.setattr(byte_bpe, "encoding", lambda ranks, pattern: Spy())
    blob = lambda ws: byte_bpe._squeeze(np.array([len(ws)], dtype="<u4").tobytes() + np.array([len(w) for w in ws], dtype="<u4").tobytes() + b"".join(ws))
    rows = [{"block": f"b{k}", "bucket": bucket, "words": blob([f"w{bucket}-{i}".encode() for i in range(k, k + 50)])} for bucket in range(3) for k in range(20)]
    got = [r for b in byte_bpe._encoded("", "")(iter([pa.RecordBatch.from_pylist(rows, schema=byte_bpe._ARROW)])) for r in b.to_pylist()]
    assert len(got) == len(rows) and len(asked) == len(set(asked)) == 3 * 69


def test_frames_without_a_steady_order_are_stored_first(spark, odd):
    assert not byte_bpe._steady(odd)
    assert byte_bpe._steady(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id > 3").select("doc_id", "text"))


def test_a_block_that_comes_in_another_order_is_an_error():
    head = {"block": "b", "bucket": -1, "docs": byte_bpe._numbers(np.array([0])), "lengths": byte_bpe._numbers(np.array([1])), "doc_ids": [1], "of_bucket": byte_bpe._numbers(np.array([3])), "counts": None, "ids": None}
    with pytest.raises(RuntimeError):
        list(byte_bpe._joined(iter([pa.RecordBatch.from_pylist([head])])))
    with pytest.raises(RuntimeError):
        list(byte_bpe._joined(iter([pa.RecordBatch.from_pylist([{**head, "bucket": 3}])])))


def test_token_files(spark, sf, docs, odd):
    encode = plain.tokenizer("word_bpe_49k.json")

    def check(df, source):
        want, at = [], 0
        for i, t in sorted(source):
            ids = [*encode(t), 1]
            want.append((i, at, len(ids), plain.crc(ids)))
            at += len(ids)
        assert sorted(map(tuple, df.collect())) == want

    check(queries.op5_token_files(spark, sf), docs)
    check(token_files.report(odd, public_tokenizers.path("word_bpe_49k.json")), [(i, t) for i, t in ODD])
    assert token_files.report(odd.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_lookup_decompresses_only_what_is_asked_for(spark, sf, docs, tmp_path):
    folder = f"file://{tmp_path}/files"
    manifest = token_files.write(spark.read.parquet(f"{sf}/documents.parquet"), folder, public_tokenizers.path("word_bpe_49k.json"), frame_tokens=500)
    encode = plain.tokenizer("word_bpe_49k.json")
    texts = dict(docs)
    got = {r["doc_id"]: np.frombuffer(r["ids"], dtype="<u4").tolist() for r in token_files.lookup(spark, manifest, folder, [3, 77, 150, 10**9]).collect()}
    assert got == {i: [*encode(texts[i]), 1] for i in (3, 77, 150)}


def test_frames_are_independent_checked_and_readable_by_others():
    out = io.BytesIO()
    writer = token_files.Writer(out, frame_tokens=4)
    for i, n in ((None, 1), (1, 3), (1, 9), (2, 0), (5, 2)):
        writer.add(i, np.arange(n, dtype="<u4").tobytes())
    writer.close()
    source = pa.BufferReader(out.getvalue())
    reader = token_files.Reader(source)
    assert len(reader.frames) == 3
    assert [(i, s, len(x) // 4) for i, s, x in reader.documents([1, 5])] == [(1, 1, 3), (1, 4, 9), (5, 13, 2)]
    import zstandard

    plain_bytes = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert len(plain_bytes) == sum(f.size for f in reader.frames)
    broken = bytearray(out.getvalue())
    broken[-9 - 4] ^= 1  # the last checksum
    with pytest.raises(ValueError):
        list(token_files.Reader(pa.BufferReader(bytes(broken))).frame(2))


def test_url_filter(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{sf}/pages.parquet')")
    got = queries.op2_url_filter(spark, sf)
    want = con.execute(url_filter.SQL)
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(want.fetchall(), key=repr)
    assert got.where("rule is not null").count() > 0


def test_url_cases(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/7x?y#z", "http://com/en/", "ftp://a://b.com/en/", "http://xcom/en/", "http://.com/en/1", "http://a.net/de/", "http://example.net/de/80", "http://example.net.:80/de/8", "http://u@h.org/es/", "http://org#x", "http://example.com/en/6", "http://example.com", "x://İ.com/en/"] + ["http://hot.org/es/1"] * 300
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string").repartition(3)
    con = duckdb.connect()
    con.register("pages", pages.toArrow())
    rules = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
    got = sorted(map(tuple, url_filter.report(pages, rules).select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    assert got == sorted(con.execute(url_filter.SQL).fetchall(), key=repr)
    assert url_filter.report(pages.limit(0)).count() == 0
    none = url_filter.judge(pages, spark.createDataFrame([], "host string, path string, action string")).collect()
    assert len(none) == len(urls) and {r["verdict"] for r in none} == {"allow"}


def test_classifier_on_held_out_documents(spark, sf):
    import zlib

    bigger = sf.replace("sf0.001", "sf0.01")
    scored = queries.op7_quality_classifier(spark, bigger).join(spark.read.parquet(f"{bigger}/labels.parquet"), "doc_id").collect()
    out = [r for r in scored if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in scored)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)
    good, bad = [r["score"] for r in out if r["quality"] == 1], [r["score"] for r in out if r["quality"] == 0]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.93
    assert np.mean([r["predicted"] == r["quality"] for r in out]) > 0.9


def test_classifier_cases(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "some text", "c"), (2, "", "b")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int")
    assert quality_classifier.report(df, labels).count() == 4
    assert quality_classifier.report(df.limit(0), labels.limit(0)).count() == 0


def test_prior_and_non_negative_risk():
    rng = np.random.default_rng(0)
    p = rng.normal(1.5, 1, (2000, 6))
    u = np.vstack([rng.normal(1.5, 1, (1400, 6)), rng.normal(-1.5, 1, (600, 6))])
    assert abs(quality_classifier.estimate_prior(p, u) - 0.7) < 0.1


CHAT = [
    (1, 0, "user", "find it"),
    (1, 1, "tool", '{"tool_call_id":"b","content":"early"}'),
    (1, 2, "assistant", '{"tool_calls":[{"id":"b","name":"search","arguments":"{\\"query\\":\\"x\\",\\"limit\\":3}"},{"name":"fetch","id":"a","arguments":{"document_id":7}}]}'),
    (1, 3, "tool", '{"content":{"z":1,"a":"é"},"tool_call_id":"a"}'),
    (1, 4, "tool", '{"tool_call_id":"nobody"}'),
    (1, 5, "tool", '{"tool_call_id":"a","content":2}'),
    (1, 300, "assistant", '{"tool_calls":[{"id":"a","name":"what","arguments":{}}]}'),
    (2, 0, None, None),
    (2, None, "assistant", "{no json"),
    (None, 0, "user", "nobody's"),
]


def test_chat_format(spark):
    df = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").withColumnRenamed("x", "x").repartition(3)
    got = {(r["conv_id"], r["segment"]): r for r in chat_format.format_chats(df, chat_format.TOOLS).collect()}
    assert set(got) == {(1, 0), (1, 1), (2, 0), (None, 0)}
    one = got[1, 0]
    chat = json.loads(one["chat"])
    assert [m["role"] for m in chat] == ["user", "assistant", "tool", "tool", "tool", "tool"]
    assert [m.get("tool_call_id") for m in chat] == [None, None, "b", "a", "nobody", "a"]
    assert chat[1]["tool_calls"][0] == {"arguments": {"limit": 3, "query": "x"}, "id": "b", "name": "search"}
    assert one["chat"] == chat_format.canonical(chat)
    assert (one["n_calls"], one["n_valid_calls"], one["n_linked"], one["n_orphans"], one["n_repeated"]) == (2, 1, 2, 1, 1)
    assert got[2, 0]["chat"] == '[{"content":"{no json","role":"assistant"},{"content":"","role":""}]'
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_schema_violations():
    s = chat_format.TOOLS["search"]
    assert chat_format.violations({"query": "a"}, s) == []
    assert chat_format.violations({"query": "", "limit": True, "x": 1}, s) == ["$.limit: not integer", "$.query: length", "$.x: unknown"]
    assert chat_format.violations([], s) == ["$: not object"]


def test_chat_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{sf}/conversations.parquet')")
    want = con.execute(chat_format.SQL)
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, queries.op10_chat_format(spark, sf).select(*names).collect()), key=repr) == sorted(want.fetchall(), key=repr)
