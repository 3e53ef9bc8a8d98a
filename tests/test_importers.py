import pytest
from pyspark.sql import functions as F

from quarry.sources import files, importers


def test_encyclopedia(spark, tmp_path):
    page = "<page><title>{}</title><ns>{}</ns><id>{}</id>{}<revision><id>7</id><timestamp>2020</timestamp><text>{}</text></revision></page>"
    pages = page.format("Apollo (ship)", 0, 100, "", "Lead text.\n== Use ==\n[[std]] C++.") + page.format("AGC", 0, 101, "<redirect title='Apollo (ship)'/>", "#REDIRECT") + page.format("Talk", 1, 102, "", "no")
    path = tmp_path / "dump.xml"
    path.write_text(f"<mediawiki>{pages}</mediawiki>")
    documents, sections = importers.read_wiki(spark, str(path))
    docs = {r["document_id"]: r for r in documents.collect()}
    assert set(docs) == {"enwiki:100", "enwiki:101"} and docs["enwiki:101"]["redirect"] == "Apollo (ship)"
    assert docs["enwiki:100"]["source_url"] == "https://en.wikipedia.org/wiki/Apollo_(ship)"
    assert [(r["document_id"], r["heading_path"], r["text"]) for r in sections.orderBy("section_index").collect()] == [("enwiki:100", [], "Lead text."), ("enwiki:100", ["Use"], "std C++.")]


def test_citations(spark, tmp_path):
    path = tmp_path / "p.xml"
    path.write_text(
        "<PubmedArticleSet><PubmedArticle><MedlineCitation Status='MEDLINE'><PMID Version='1'>42</PMID><DateRevised><Year>2021</Year><Month>02</Month><Day>3</Day></DateRevised>"
        "<Article><Journal><ISSN>1-2</ISSN><JournalIssue><Volume>5</Volume><Issue>1</Issue><PubDate><Year>2020</Year><Month>Mar</Month></PubDate></JournalIssue><Title>J</Title></Journal><ArticleTitle>Heart  study</ArticleTitle>"
        "<Abstract><AbstractText Label='METHODS'>We did.</AbstractText><AbstractText>Found.</AbstractText></Abstract><AuthorList><Author><LastName>Roe</LastName><ForeName>Jo</ForeName></Author><Author><CollectiveName>Group</CollectiveName></Author></AuthorList><Language>eng</Language></Article>"
        "<MeshHeadingList><MeshHeading><DescriptorName UI='D1'>Heart</DescriptorName><QualifierName UI='Q1'>physiology</QualifierName></MeshHeading></MeshHeadingList><KeywordList><Keyword MajorTopicYN='N'>beat</Keyword></KeywordList></MedlineCitation>"
        "<PubmedData><ArticleIdList><ArticleId IdType='pubmed'>42</ArticleId><ArticleId IdType='doi'>10.1/x</ArticleId></ArticleIdList></PubmedData></PubmedArticle>"
        "<PubmedArticle><MedlineCitation><PMID Version='1'>43</PMID><Article><Journal><Title>J</Title></Journal><ArticleTitle>Bare</ArticleTitle></Article></MedlineCitation></PubmedArticle></PubmedArticleSet>"
    )
    documents, blocks = importers.read_citations(spark, str(path))
    doc = documents.where("pmid = '42'").first()
    assert (doc["title"], doc["publication_date"], doc["revised_date"], doc["doi"], doc["authors"], doc["mesh_terms"]) == ("Heart study", "2020-03", "2021-02-03", "10.1/x", ["Roe, Jo", "Group"], ["Heart / physiology"])
    got = [(r["document_id"][-2:], r["heading_path"], r["text"]) for r in blocks.orderBy("document_id", "block_index").collect()]
    assert got == [
        ("42", ["Abstract", "METHODS"], "We did."), ("42", ["Abstract"], "Found."), ("42", ["Indexing"], "MeSH terms: Heart / physiology\nKeywords: beat"),
        ("43", ["Citation"], "Bare. Journal: J"),
    ]


def test_posts(spark, tmp_path):
    row = "<row Id='{}' PostTypeId='{}' {} Score='{}' Body='&lt;p&gt;b&lt;/p&gt;' CreationDate='2020' {}/>"
    (tmp_path / "Posts.xml").write_text(
        "<posts>" + row.format(10, 1, "AcceptedAnswerId='11' Title='Q?' Tags='&lt;a&gt;&lt;b&gt;'", 3, "OwnerUserId='1'") + row.format(11, 2, "ParentId='10'", 0, "OwnerDisplayName='own' OwnerUserId='1'")
        + row.format(12, 2, "ParentId='10'", 4, "") + row.format(13, 2, "ParentId='10'", -1, "") + row.format(1000000001, 1, "Title='no'", 1, "") + "</posts>"
    )
    (tmp_path / "Users.xml").write_text("<users><row Id='1' DisplayName='user one'/></users>")
    got = importers.read_posts(spark, str(tmp_path), "so").orderBy("place").collect()
    assert [r["document_id"] for r in got] == ["so:post:10", "so:post:11", "so:post:12"]
    assert [r["author"] for r in got] == ["user one", "own", None] and got[0]["tags"] == ["a", "b"] and {r["title"] for r in got} == {"Q?"}


def test_trees_and_inventories(spark, tmp_path):
    (tmp_path / "docs" / ".git").mkdir(parents=True)
    (tmp_path / "docs" / "a.md").write_text("# A\n\ntext")
    (tmp_path / "docs" / "b.xml").write_text("<broken")
    (tmp_path / "docs" / "c.png").write_bytes(b"x")
    (tmp_path / "docs" / ".git" / "d.md").write_text("no")
    tree = files.read_tree(spark, str(tmp_path / "docs"))
    rows = {r["relative"]: r["p"] for r in tree.select("relative", files.parsed_column(spark, F.col("relative"), F.col("content")).alias("p")).collect()}
    assert set(rows) == {"a.md", "b.xml"} and rows["a.md"]["title"] == "A" and rows["b.xml"]["error"]
    before = spark.createDataFrame(files.inventory(spark, str(tmp_path / "docs")).collect())
    (tmp_path / "docs" / "a.md").write_text("# B")
    (tmp_path / "docs" / "e.md").write_text("new")
    (tmp_path / "docs" / "c.png").unlink()
    after = files.inventory(spark, str(tmp_path / "docs"))
    assert {r["relative"]: r["state"] for r in files.compare_inventories(before, after).collect()} == {"a.md": "changed", "e.md": "new", "c.png": "missing"}


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a":1}\n\n{"a":2}\n')
    assert files.read_json_lines(spark, str(tmp_path / "x.jsonl"), "a int").count() == 2
    (tmp_path / "y.jsonl").write_text('{"a":1}\n{broken\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_json_lines(spark, str(tmp_path / "y.jsonl"), "a int").collect()
