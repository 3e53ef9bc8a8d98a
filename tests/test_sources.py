import bz2

import pytest
from pyspark.sql import functions as F

from quarry.sources import includes, multistream, records, registry


def test_legacy_records(spark):
    docs = spark.createDataFrame([("enwiki:1", "T", "http://x", "2020", True)], "document_id string, title string, url string, revision_timestamp string, stub boolean")
    assert not records.is_native(docs)
    row = records.legacy_documents(docs).first()
    assert (row["corpus"], row["source_timestamp"], row["attributes"]) == ("wikipedia-en", "2020", '{"stub":true}')
    chunks = spark.createDataFrame([("b", "d", 1, 0, "two"), ("a", "d", 0, 0, "one")], "chunk_id string, document_id string, section_index int, chunk_index int, text string").withColumn("heading_path", F.lit(None).cast("array<string>"))
    got = records.legacy_chunks(chunks).orderBy("ordinal").collect()
    assert [(r["chunk_instance_id"], r["ordinal"], r["next_chunk_id"], r["attributes"]) for r in got] == [("a", 0, "b", '{"chunk_index":0,"section_index":0}'), ("b", 1, None, '{"chunk_index":0,"section_index":1}')]
    mixed = spark.createDataFrame([("c",), (None,)], "corpus string")
    with pytest.raises(ValueError):
        records.is_native(mixed)


def test_problems_and_gates(spark):
    df = spark.createDataFrame([("a", "text", 0, 4), (" ", "text", -1, 5)], "chunk_instance_id string, text string, ordinal int, character_count int")
    assert records.problems(df, ["chunk_instance_id"], True).first()["problems"] == ["chunk_instance_id is missing", "ordinal is negative", "character_count is wrong"]
    assert records.manifest_parts({"parts": [{"part": 2, "documents": "b", "chunks": "c"}, {"part": 1, "documents": "a", "chunks": "c"}]})[0][0] == 1
    for bad in ([{"part": 1, "documents": "../x", "chunks": "c"}], [{"part": 1, "documents": "a", "chunks": "c"}] * 2):
        with pytest.raises(ValueError):
            records.manifest_parts({"parts": bad})
    records.require_complete({"stop_reason": "end_of_input"})
    with pytest.raises(ValueError):
        records.require_complete({"stop_reason": "max_pages"})
    a = spark.createDataFrame([("x", 1, "h"), ("y", 2, "i")], "relative string, length long, sha256 string")
    assert records.fingerprint(a) == records.fingerprint(a.orderBy(F.desc("relative"))) != records.fingerprint(a.where("relative = 'x'"))


def test_registry(spark):
    good = {"id": "rfc", "title": "R", "license": "L", "stage": "indexed", "acquisition": "rsync", "download_bytes": 5}
    assert registry.registry_problems([good]) == {}
    assert set(registry.registry_problems([good, {**good, "stage": "x", "index_bytes": -1}])["rfc"]) == {"stage is unknown", "index_bytes is no size", "id repeats"}
    assert registry.storage_summary(spark, [good, good]).first()["download_bytes"] == 10
    models = [{"id": "b", "roles": ["embedding"], "priority": 1}, {"id": "a", "roles": ["embedding"], "priority": 1}, {"id": "c", "roles": ["chat"], "priority": 0}]
    assert registry.choose_model(models, "embedding")["id"] == "a"
    with pytest.raises(LookupError):
        registry.choose_model(models, "rerank")


def test_multistream(spark, tmp_path):
    page = "<page><title>{0}</title><ns>0</ns><id>{1}</id><revision><id>1</id><text>Body {0}</text></revision></page>"
    streams = [bz2.compress(b"<mediawiki>")] + [bz2.compress("".join(page.format(t, i) for t, i in g).encode()) for g in ([("A: x", 1), ("B", 2)], [("C", 3)])] + [bz2.compress(b"</mediawiki>")]
    (tmp_path / "d.bz2").write_bytes(b"".join(streams))
    at = len(streams[0])
    (tmp_path / "i.txt").write_text(f"{at}:1:A: x\n{at}:2:B\n{at + len(streams[1])}:3:C\n")
    end = at + len(streams[1]) + len(streams[2])
    found = multistream.blocks(multistream.read_index(spark, str(tmp_path / "i.txt")), end)
    assert [(p, n) for p, _, _, n in multistream.parts(found)] == [(0, 2), (0, 1)]
    pages = multistream.parse_pages(multistream.read_pages(found, str(tmp_path / "d.bz2")))
    assert sorted((r["id"], r["title"], r["revision"]["text"]["_VALUE"]) for r in pages.collect()) == [(1, "A: x", "Body A: x"), (2, "B", "Body B"), (3, "C", "Body C")]
    with pytest.raises(Exception, match="pages"):
        multistream.read_pages(found.withColumn("pages", F.lit(9)), str(tmp_path / "d.bz2")).collect()


def test_includes(spark):
    rows = [("docs/a.md", "start\n[!INCLUDE [x](../shared/b.md)]\nend"), ("shared/b.md", "inner\n[!INCLUDE [y](c.md)]"), ("shared/c.md", "deep")]
    got = {r["relative"]: r["text"].split() for r in includes.expand_includes(spark.createDataFrame(rows, "relative string, text string")).collect()}
    assert got == {"docs/a.md": ["start", "inner", "deep", "end"], "shared/b.md": ["inner", "deep"], "shared/c.md": ["deep"]}
    for bad in ([("a.md", "[!INCLUDE [x](a.md)]")], [("a.md", "[!INCLUDE [x](../b.md)]")]):
        with pytest.raises(ValueError):
            includes.expand_includes(spark.createDataFrame(bad, "relative string, text string"))
