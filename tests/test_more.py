"""Vector generations, evaluation, paged documents, catalogs, guides, options, the command line and others."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry import __main__ as command
from quarry import options
from quarry.operators import chunking, corpus, lexical, semantic
from quarry.operators.lexical import tokens_plain
from quarry.plans import evaluate, publish, vector_generations
from quarry.session import Collection, Corpus
from quarry.sources import catalog, guides, includes, paged, records

CHUNKS = "row_id long, document_id string, title string, heading string, text string, ordinal int, front_matter boolean"


def test_vectors_are_built_in_steps_reused_and_verified(spark, tmp_path):
    root, asked = f"file://{tmp_path}/vectors", []
    plain = semantic.keyword_provider([["rocket"], ["bread"]])

    def provider(texts):
        return plain(texts)

    records_ = spark.createDataFrame([(i, f"{'rocket' if i % 2 else 'bread'} {i // 4}") for i in range(40)], "id long, text string").repartition(3)
    identity = {"model": "words", "version": 1}
    assert vector_generations.build_vectors(root, records_, provider, 3, identity, "b1", slices=4, stop_after=2) is None
    with pytest.raises(FileNotFoundError):
        publish.current(spark, root)
    assert vector_generations.build_vectors(root, records_, provider, 3, identity, "b1", slices=4, stop_after=2)
    assert not vector_generations._exists(spark, f"{root}/.building-x") and vector_generations.verify_vectors(spark, root, "b1", identity) == []
    assert vector_generations.verify_vectors(spark, root, "b2", {"model": "other"}) == ["the vectors belong to another build of the index", "another provider made the vectors"]
    ids = publish.current(spark, root)[1]("vectors").orderBy("id").select("id", "vector_id").collect()
    assert [r["vector_id"] for r in ids] == list(range(40))

    def refuse(texts):
        if texts:
            raise RuntimeError("asked again")
        return np.zeros((0, 3), dtype=np.float32)

    vector_generations.build_vectors(root, records_, refuse, 3, identity, "b2", slices=4)
    known, _ = publish.current(spark, root)
    assert known["meta"]["reused"] == 40 and asked == []
    assert vector_generations.open_vectors(spark, root).count() == 40


def test_a_generation_with_faults_is_not_published(spark):
    rows = [(0, 1, "a", [1.0, 0.0]), (2, 2, "b", [0.0, 0.0]), (3, None, None, None)]
    found = vector_generations.problems(spark.createDataFrame(rows, "vector_id long, id long, fingerprint string, embedding array<double>"), 2)
    assert len(found) == 3 and "not 0 to n - 1" in found[0]


def test_dense_ids(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k")).repartition(7)
    got = vector_generations.dense_ids(rows, "k").orderBy("k").collect()
    assert [r["vector_id"] for r in got] == list(range(1000)) and [r["k"] for r in got] == sorted(r["k"] for r in got)


SUITE = {
    "schema_version": 2, "name": "s", "cases": [
        {"id": "1", "query": "rocket", "relevance": {"a": 2, "b": 1}, "query_type": "short"},
        {"id": "2", "query": "bread", "relevance": {"c": 1}},
    ],
}


def test_any_retriever_is_evaluated():
    answers = {"rocket": [{"document_id": "x", "alternates": ["b"]}, {"document_id": "a"}, {"document_id": "a"}], "bread": []}
    report = evaluate.evaluate(SUITE, lambda query, limit, mode: answers[query], {"retriever": "made"})
    one, two = report["cases"]
    assert one["metrics"]["success@1"] == 1 and one["metrics"]["recall@5"] == 1 and two["metrics"]["mrr@10"] == 0
    assert report["overall"]["mrr@10"] == 0.5 and report["by_query_type"]["short"]["cases"] == 1 and report["retriever"] == "made"
    assert one["metrics"]["ndcg@10"] == pytest.approx((1 + 3 / np.log2(3)) / (3 + 1 / np.log2(3)), abs=1e-6)
    titled = {"cases": [{"query": "q", "expected_titles": ["T"]}]}
    got = evaluate.evaluate(titled, lambda *_: [{"document_id": "1", "title": "S"}, {"document_id": "2", "title": "T"}])["cases"][0]["metrics"]
    assert got["mrr@10"] == 0.5 and not any(n.startswith("ndcg") for n in got)
    with pytest.raises(ValueError):
        evaluate.evaluate({"cases": []}, lambda *_: [])


@pytest.fixture(scope="module")
def held(spark):
    words = " ".join(f"w{i}" for i in range(20))
    a = [(1, "a", "Apollo Guidance", "", f"The rocket computer {words}", 0, False), (2, "b", "Rockets", "Design > Fuel", "rocket fuel RFC 793 burns", 0, False)]
    b = [(7, "c", "Copies", "", f"The rocket computer {words}", 0, False), (8, "d", "Bread", "", "bread has no fuel, a rocket salad", 0, False)]
    frames = [spark.createDataFrame(rows, CHUNKS).withColumn("url", F.concat(F.lit("http://x/"), "document_id")).cache() for rows in (a, b)]
    provider = semantic.keyword_provider([["rocket"], ["bread"]])
    vectors = semantic.embed(frames[0], provider).select(F.col("row_id").alias("vec_id"), "embedding").cache()
    return Collection(spark, [Corpus("space", frames[0], lexical.build_index(frames[0]).cache(), vectors), Corpus("food", frames[1], lexical.build_index(frames[1]).cache())], provider)


def test_federated_search_reranks_and_sets_copies_aside(held):
    found = held.find("rocket RFC 793 fuel", mode="or", retrieval="bm25")
    rows = found.results.collect()
    assert found.reranked and rows[0]["document_id"] == "b" and rows[0]["rerank_score"] > 0.03
    copies = [r for r in rows if r["text"].startswith("The rocket computer")]
    assert len(copies) == 1 and found.duplicates.count() == 1 and len(copies[0]["alternates"]) == 1
    assert [r["position"] for r in rows] == list(range(1, len(rows) + 1))
    assert rows[0]["label"] == "S1" and rows[0]["markdown"] == "[S1] space — Rockets § Design > Fuel http://x/b <http://x/b>"
    both = held.find("rocket", mode="or", retrieval="bm25", deduplicate=False).results.collect()
    assert len([r for r in both if r["text"].startswith("The rocket computer")]) == 2


def test_exact_titles_come_first_across_corpora(held):
    rows = held.search("apollo guidance", rerank=False).collect()
    assert rows[0]["document_id"] == "a"
    assert not held.find("rocket", names=["space"], retrieval="bm25").reranked
    assert held.find("rocket", names=["space"], retrieval="bm25", mode="or").results.first()["rerank_score"] is None


def test_a_provider_that_fails_leaves_the_words(spark, held):
    def broken(texts):
        raise OSError("no model")

    other = Collection(spark, list(held.corpora.values()), broken)
    found = other.find("rocket", retrieval="hybrid", names=["space"])
    assert found.retrieval["space"]["used"] == "bm25" and "no model" in found.retrieval["space"]["fallback_reason"] and found.results.count() > 0
    short = Collection(spark, list(held.corpora.values()), lambda texts: [[1.0]])
    assert "dimensions" in short.find("rocket", retrieval="semantic", names=["space"]).retrieval["space"]["fallback_reason"]
    hybrid = held.find("rocket", retrieval="hybrid", names=["space"], mode="or")
    assert hybrid.retrieval["space"]["used"] == "hybrid" and hybrid.reranked


def test_the_reranked_path_is_evaluated(held):
    suite = {"schema_version": 2, "cases": [{"id": "1", "query": "rocket fuel", "relevance": {"b": 1}, "query_mode": "or"}]}
    report = evaluate.evaluate_collection(suite, held, "bm25")
    assert report["overall"]["success@5"] == 1.0 and report["corpora"] == ["food", "space"]


RECIPE = """There are 2 ways to make this drink
1. With sugar and salt
Put half a level teaspoon of salt and 8 level teaspoons of sugar in a litre of clean water and stir it.
2. With powdered cereal and salt
Put half a level teaspoon of salt and 8 heaped teaspoons of powdered cereal in a litre of water, and boil it.
If possible, add half a cup of fruit juice or coconut water or mashed ripe banana to either drink.
"""


def test_methods_of_a_page(spark):
    blocks = paged.page_blocks(["Page 1"], RECIPE, {"page_number": "1"}, True)
    assert [b.attributes.get("evidence_kind") for b in blocks] == [None, "procedure_method", "procedure_method", "procedure_shared"]
    assert blocks[1].heading_path == ["Page 1", "Rehydration drink", "1. With sugar and salt"]
    assert len(paged.page_blocks([], RECIPE.replace("2 ways", "ways"), {}, True)) == 1
    mixed = RECIPE.replace("and boil it", "and boil it with sugar")
    assert [b.attributes.get("procedure_method") for b in paged.page_blocks([], mixed, {}, True)[1:3]] == ["1. With sugar and salt", None]
    pages = [("a", 1, "i", "text", False, ["One"]), ("a", 2, "", None, True, None), ("a", 3, "3", " ", False, ["Two"]), ("b", 1, None, None, True, None)]
    df = spark.createDataFrame(pages, "relative string, page int, label string, text string, has_images boolean, outline array<string>")
    got = {(r["relative"], r["page"]): r for r in paged.headed_pages(df).collect()}
    assert got["a", 2]["heading_path"] == ["One", "Page 2"] and got["a", 1]["front_matter"] and not got["a", 2]["front_matter"]
    assert {r["relative"]: tuple(r)[1:] for r in paged.searchable(df).collect()} == {"a": (1, 1, 1, 0.5), "b": (0, 1, 0, 0.0)}
    with pytest.raises(ValueError, match="b: 0 pages"):
        paged.require_searchable(df)
    assert paged.require_searchable(df.where("relative = 'a'")).count() == 3


def test_links_assets_and_hashes(spark):
    html = "<a href='/d/A%20b.pdf'>Part <b>one</b></a><!-- <a href='no'> --><script>'<a href=no>'</script><a href=x>p<a href=y>q</a><area href='z'>"
    assert catalog.anchors(html) == [("/d/A%20b.pdf", "Part one"), ("x", "p q"), ("z", "")]
    links = [("http://h/d/b.pdf", "B"), ("http://h/d/a.pdf", ""), ("http://h/d/a.pdf?x", "no"), ("http://h/e.pdf", "no")]
    assert catalog.select_assets(links, "http://h/d/", r".+\.pdf", excluded=("b.pdf",)) == [("a.pdf", "http://h/d/a.pdf", "a.pdf")]
    for bad in ({"least": 3}, {"most": 1}, {"excluded": ("c.pdf",)}):
        with pytest.raises(ValueError):
            catalog.select_assets(links, "http://h/d/", r".+\.pdf", **bad)
    with pytest.raises(ValueError):
        catalog.relative_asset("http://h/", "http://h/a/%2e%2e/b")
    text = spark.createDataFrame([("# c",), ("",), (f"{'A' * 40}  one",), (f"{'a' * 40} *one",), (f"{'b' * 40}  two",)], "value string")
    expected = catalog.checksum_list(text)
    assert {tuple(r) for r in expected.collect()} == {("one", "a" * 40), ("two", "b" * 40)}
    files = spark.createDataFrame([("one", "x"), ("three", "")], "name string, content string")
    assert {r["name"]: r["state"] for r in catalog.checked_files(files, expected).collect()} == {"one": "differs", "two": "missing", "three": "unlisted"}
    with pytest.raises(ValueError):
        catalog.checksum_list(spark.createDataFrame([("no entry",)], "value string"))


def test_pages_that_can_be_reached(spark):
    pages = [("http://h/a/", "<a href='b.html'>b</a><a href='http://other/'>no</a>"), ("http://h/a/b.html", "<a href='c.html?q#f'>c</a><a href='../x.html'>no</a>"), ("http://h/a/c.html", "<a href='/a/index.html'>a</a>"), ("http://h/a/lone.html", ""), ("http://h/x.html", "")]
    df = spark.createDataFrame(pages, "url string, html string")
    got = {r["url"]: r["depth"] for r in catalog.reachable(df, "http://h/a/", "http://h/a/").collect()}
    assert got == {"http://h/a/": 0, "http://h/a/b.html": 1, "http://h/a/c.html": 2}


GUIDE = """<html><head><meta name="title" content="Phone Battery Replacement - Site"><meta name="description" content="Swap it."><meta name="keywords" content="x, Phone">
<meta itemprop="datePublished" content="2020-01-01"><link rel="canonical" href="https://s/Guide/P/12"></head><body>
<div class="item-list-tools"><p class="title" itemprop="name">Spudger</p></div>
<div data-name="GuideTopComponent" data-props="{&quot;productData&quot;:{&quot;parts&quot;:[{&quot;name&quot;:&quot;Cell&quot;,&quot;quantity&quot;:2}]}}"></div>
<div class="details-item difficulty"><p class="item-value">Hard</p></div>
<ul><li class="step step-wrapper" data-step-number="3"><strong class="stepValue">Step 4</strong><span class="stepTitleTitle">Open</span><img src="a.jpg" alt="case"><img src="b.jpg">
<ul class="step-lines"><li class="level-1"><div class="bullet_red"></div><p>Pry <b>here</b>.</p></li><li><p>Lift.</p></li></ul></li>
<li class="step-wrapper"><ul class="step-lines"><li><p>Done</p></li></ul></li><li class="step-wrapper"></li></ul></body></html>"""


def test_repair_guides():
    g = guides.parse_guide("A/Guide/Phone+Battery/12", GUIDE)
    assert (g.guide_id, g.kind, g.title, g.category, g.difficulty, g.published) == ("12", "guide", "Phone Battery Replacement", "Phone", "Hard", "2020-01-01")
    assert [(s.number, s.title, [tuple(vars(x).values()) for x in s.lines]) for s in g.steps] == [(4, "Open", [("Pry here .", 1, "red"), ("Lift.", 0, None)]), (2, "Step 2", [("Done", 0, None)])]
    assert g.steps[0].images == [{"url": "a.jpg", "alt": "case"}] and g.tools == [{"name": "Spudger"}] and g.parts == [{"name": "Cell", "quantity": 2}]
    chunks = guides.guide_chunks(g)
    assert chunks[0][1].split("\n")[2:] == ["Tools: Spudger", "Parts: Cell", "Difficulty and time: Hard"]
    assert chunks[1][:2] == (["Phone Battery Replacement", "Step 4", "Open"], "Step 4: Open\n  - [RED] Pry here .\n- Lift.") and chunks[1][2]["safety_sensitive"] and not chunks[2][2]["safety_sensitive"]
    assert guides.parse_guide("A/Info/x", GUIDE) is None and guides.parse_guide("Guide/x/1", "<h1>T</h1>") is None


def test_splits_of_records_and_steps():
    assert chunking.split_fields("a b c; d e f. g h\ni j", 10) == ["a b c; d e", "f. g h\ni j"]
    assert chunking.split_fields("x" * 25, 10) == ["x" * 10, "x" * 10, "x" * 5]
    assert chunking.split_lines("one\ntwo\nthree four five", 10) == ["one\ntwo", "three four", "five"]


def test_includes_fold_paths_and_xml(spark):
    files = [("a/b/c/d/e/f/g/h/one.md", "top\n[!INCLUDE [t](../../../../../../../../two.md)]\n"), ("two.md", "body"), ("bad.md", "[!INCLUDE [t](../../x.md)]")]
    df = spark.createDataFrame(files, "relative string, text string")
    got = {r["relative"]: r["text"] for r in includes.expand_includes(df.where("relative <> 'bad.md'")).collect()}
    assert "body" not in got["a/b/c/d/e/f/g/h/one.md"] or got["a/b/c/d/e/f/g/h/one.md"].split() == ["top", "body"]
    with pytest.raises(ValueError):
        includes.expand_includes(df).collect()
    xml = [("m/main.xml", "<?xml version='1.0'?>\n<refentry><xi:include href='../p.xml'/></refentry>"), ("p.xml", "<?xml version='1.0'?><para>in</para>")]
    got = {r["relative"]: r["text"] for r in includes.expand_xincludes(spark.createDataFrame(xml, "relative string, text string")).collect()}
    assert got["m/main.xml"].replace("\n", "") == "<refentry><para>in</para></refentry>"


def test_columns_of_evidence_and_key_pages(spark):
    rows = [(1, json.dumps({"front_matter": True, "procedure_method": "m", "revision_timestamp": "t2"}), "t1"), (2, json.dumps({"evidence_kind": "k"}), "t1"), (3, "{}", None)]
    got = corpus.evidence_columns(spark.createDataFrame(rows, "id long, attributes string, source_timestamp string")).orderBy("id").collect()
    assert [(r["front_matter"], r["evidence_kind"], r["revision_timestamp"]) for r in got] == [(True, "procedure_method", "t2"), (False, "k", "t1"), (False, "source_chunk", None)]
    numbers = spark.range(100).withColumnRenamed("id", "k")
    assert [r["k"] for r in corpus.keyset_page(numbers, "k", 41, 3).collect()] == [42, 43, 44] and corpus.keyset_page(numbers, "k", None, 2).count() == 2


def test_parts_of_a_manifest(spark, tmp_path):
    for k in (2, 1):
        (tmp_path / f"d{k}.jsonl").write_text(json.dumps({"document_id": f"x{k}"}) + "\n")
    manifest = {"parts": [{"part": k, "documents": f"d{k}.jsonl", "chunks": f"c{k}.jsonl"} for k in (2, 1)]}
    got = records.read_parts(spark, str(tmp_path), manifest, "documents", "document_id string").orderBy("part").collect()
    assert [tuple(r) for r in got] == [("x1", 1), ("x2", 2)]
    a, b = (spark.createDataFrame([("f", n)], "relative string, length long") for n in (1, 2))
    records.require_unchanged(a, a)
    with pytest.raises(ValueError):
        records.require_unchanged(a, b)


def test_options():
    assert options.mapping(["a=/x", "b=y=z"], "--index") == {"a": "/x", "b": "y=z"}
    assert options.aliases(["a=LM=>lunar module"], ["a", "b"]) == {"a": {"LM": "lunar module"}, "b": {}}
    assert options.routes(["a=x|y", "a=z"], ["a"]) == {"a": "(?:x|y)|(?:z)"}
    for call in (lambda: options.mapping(["a"], "x"), lambda: options.mapping(["a=1", "a=2"], "x"), lambda: options.aliases(["c=x=>y"], ["a"]), lambda: options.aliases(["a=x"], ["a"]), lambda: options.routes(["b=x"], ["a"])):
        with pytest.raises(ValueError):
            call()


def test_command_line(spark, tmp_path, capsys):
    rows = [(1, "a", "Rockets", "", "rocket fuel burns", 0, False), (2, "b", "Bread", "", "yeast and flour", 0, False)]
    chunks, root = f"file://{tmp_path}/chunks", f"file://{tmp_path}/index"
    spark.createDataFrame(rows, CHUNKS).write.parquet(chunks)
    assert command.main(["build", chunks, root], spark) == 0
    assert command.main(["verify", root, "--smoke", "rocket"], spark) == 0
    assert command.main(["verify", root, "--smoke", "absent"], spark) == 1
    capsys.readouterr()
    assert command.main(["query", "LM fuel", "--chunks", f"c={chunks}", "--index", f"c={root}", "--query-alias", "c=LM=>rocket"], spark) == 0
    assert json.loads(capsys.readouterr().out)["results"][0]["document_id"] == "a"
    for name, h in (("old", "1"), ("new", "2")):
        spark.createDataFrame([("d", h)], "document_id string, content_hash string").write.parquet(f"file://{tmp_path}/{name}")
    assert command.main(["plan", f"file://{tmp_path}/old", f"file://{tmp_path}/new"], spark) == 0
    assert json.loads(capsys.readouterr().out)["changes"][0]["change"] == "modified"


def test_tokens_on_the_driver_equal_those_of_the_engine(spark):
    from quarry.functions.text import nfc, tokens

    texts = ["na\u0131ve \u0915\u093f\u0924\u093e\u092c x\ue000y", "e\u0301a \u1e9e \u01c4 \uac01 \u1100\u1161\u11a8", "\u0958 \u212b \u0344 A\u030a", "plain"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").orderBy("i")
    import unicodedata

    got = df.select(tokens(F.col("s")).alias("t"), nfc(F.col("s")).alias("n")).collect()
    assert [r["t"] for r in got] == [tokens_plain(t) for t in texts]
    assert [r["n"] for r in got] == [unicodedata.normalize("NFC", t) for t in texts]


def test_python_sees_only_the_rows_that_need_it(spark, monkeypatch):
    from quarry.functions import text

    def spy(v):
        if v.isascii():
            raise ValueError("a plain row came to Python")
        return v.casefold()

    df = spark.createDataFrame([(t,) for t in ["a"] * 50 + ["\u00c9"] + [None]], "s string")
    got = df.select(text._where(~F.col("s").rlike(text._ASCII), text._on_rows(spy), F.col("s"), F.lower("s")).alias("x")).collect()
    assert [r["x"] for r in got] == ["a"] * 50 + ["\u00e9", None]


def test_the_sql_function(spark):
    from quarry.functions.text import register

    register(spark)
    got = spark.sql("SELECT technical_normalized(t) AS x FROM VALUES ('uses C++ now'), ('plain'), (NULL) AS v(t)").collect()
    assert [r["x"] for r in got] == ["uses cpp now", "", None]
    assert semantic.instructed("q", "find") == "Instruct: find\nQuery: q" and semantic.instructed("q", "") == "q"
