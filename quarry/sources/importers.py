"""Dumps of articles, posts, citations and guides as documents and blocks.

The XML source of Spark splits a dump into rows; what is left are column expressions, and Arrow functions only for
wiki text and HTML.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.corpus import retain_answers
from quarry.runtime import column_in_slices, ship
from quarry.schema import BLOCK
from quarry.sources.files import read_xml
from quarry.sources.markup import parse_html, wiki_sections
from quarry.sources.xml_docs import registry_records, render_record

# ---- encyclopedia pages

PAGE = "title STRING, ns INT, id BIGINT, redirect STRUCT<_VALUE: STRING, _title: STRING>, revision STRUCT<id: BIGINT, timestamp: STRING, text: STRUCT<_VALUE: STRING>>"
_SECTION = T.ArrayType(T.StructType([T.StructField("heading_path", T.ArrayType(T.StringType())), T.StructField("text", T.StringType())]))


def _read_sections(values: pd.Series) -> pd.Series:
    return values.map(lambda v: [{"heading_path": path, "text": body} for path, body in wiki_sections(v or "")])


_sections = column_in_slices(_read_sections, _SECTION)


def article_url(title: Column) -> Column:
    safe = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for code, sign in (("%28", "("), ("%29", ")"), ("%21", "!"), ("%27", "'"), ("%2C", ","), ("%7E", "~"), ("%2F", "/")):
        safe = F.replace(safe, F.lit(code), F.lit(sign))
    return F.concat(F.lit("https://en.wikipedia.org/wiki/"), safe)


def wiki_pages(pages: DataFrame, corpus: str = "enwiki") -> tuple[DataFrame, DataFrame]:
    """(documents, sections) of article pages; a redirect is a document without sections."""
    ship(pages.sparkSession)
    articles = pages.where("ns = 0").select(
        F.concat(F.lit(corpus + ":"), F.col("id").cast("string")).alias("document_id"), "title", article_url(F.col("title")).alias("source_url"), F.col("revision.id").cast("string").alias("source_version"),
        F.col("revision.timestamp").alias("source_timestamp"), F.coalesce(F.col("redirect._title"), F.lit(None).cast("string")).alias("redirect"), F.col("revision.text._VALUE").alias("wikitext"),
    )
    bodies = articles.where("redirect IS NULL").select("document_id", F.posexplode(_sections("wikitext")).alias("section_index", "section"))
    return articles.drop("wikitext"), bodies.select("document_id", "section_index", "section.heading_path", "section.text")


def read_wiki(spark: SparkSession, path: str, corpus: str = "enwiki") -> tuple[DataFrame, DataFrame]:
    return wiki_pages(read_xml(spark, path, "page", PAGE), corpus)


# ---- biomedical citations

_DATE = "STRUCT<Year: STRING, Month: STRING, Day: STRING, MedlineDate: STRING>"
_VALUE = "STRUCT<_VALUE: STRING{}>"
CITATION = f"""
MedlineCitation STRUCT<_Status: STRING, PMID: {_VALUE.format(', _Version: STRING')}, DateCompleted: {_DATE}, DateRevised: {_DATE},
  Article: STRUCT<
    Journal: STRUCT<ISSN: {_VALUE.format(', _IssnType: STRING')}, JournalIssue: STRUCT<Volume: STRING, Issue: STRING, PubDate: {_DATE}>, Title: STRING, ISOAbbreviation: STRING>,
    ArticleTitle: STRING, Abstract: STRUCT<AbstractText: ARRAY<{_VALUE.format(', _Label: STRING, _NlmCategory: STRING')}>>,
    AuthorList: STRUCT<Author: ARRAY<STRUCT<LastName: STRING, ForeName: STRING, Initials: STRING, CollectiveName: STRING>>>,
    Language: ARRAY<STRING>, ArticleDate: ARRAY<{_DATE}>>,
  MeshHeadingList: STRUCT<MeshHeading: ARRAY<STRUCT<DescriptorName: {_VALUE.format(', _UI: STRING')}, QualifierName: ARRAY<{_VALUE.format(', _UI: STRING')}>>>>,
  KeywordList: STRUCT<Keyword: ARRAY<{_VALUE.format(', _MajorTopicYN: STRING')}>>>,
PubmedData STRUCT<ArticleIdList: STRUCT<ArticleId: ARRAY<{_VALUE.format(', _IdType: STRING')}>>>
"""
_MONTHS = {m: f"{i:02d}" for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}


def citation_date(date: Column) -> Column:
    """Year, with month and day if they are known; month names as numbers; else the free form."""
    table = F.create_map(*(F.lit(x) for pair in _MONTHS.items() for x in pair))
    month, day = date["Month"], date["Day"]
    number = F.coalesce(F.try_element_at(table, F.lower(F.substring(month, 1, 3))), F.when(month.rlike(r"^\d+$"), F.lpad(month, 2, "0")), month)
    days = F.when(month.isNotNull() & day.isNotNull(), F.concat(F.lit("-"), F.when(day.rlike(r"^\d$"), F.lpad(day, 2, "0")).otherwise(day)))
    known = F.concat(date["Year"], F.coalesce(F.concat(F.lit("-"), number), F.lit("")), F.coalesce(days, F.lit("")))
    return F.coalesce(known, date["MedlineDate"])


def _tidy(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def citations(rows: DataFrame, corpus: str = "pubmed") -> tuple[DataFrame, DataFrame]:
    """(documents, blocks): labelled abstract parts, then a block of index terms, or a fallback of the citation."""
    article, data = F.col("MedlineCitation.Article"), F.col("PubmedData.ArticleIdList.ArticleId")
    name = lambda a: F.coalesce(a["CollectiveName"], F.nullif(F.concat_ws(", ", a["LastName"], F.coalesce(a["ForeName"], a["Initials"])), F.lit("")))
    empty = F.array().cast("array<string>")
    mesh = F.transform(
        F.col("MedlineCitation.MeshHeadingList.MeshHeading"),
        lambda h: F.concat(h["DescriptorName"]["_VALUE"], F.when(F.size(h["QualifierName"]) > 0, F.concat(F.lit(" / "), F.array_join(F.transform(h["QualifierName"], lambda q: q["_VALUE"]), ", "))).otherwise("")),
    )
    first_id = lambda kind: F.get(F.transform(F.filter(data, lambda i: F.lower(i["_IdType"]) == kind), lambda i: i["_VALUE"]), 0)
    pmid = F.trim(F.col("MedlineCitation.PMID._VALUE"))
    docs = rows.where(F.length(pmid) > 0).select(
        F.concat(F.lit(corpus + ":pmid:"), pmid).alias("document_id"), pmid.alias("pmid"), F.coalesce(F.nullif(_tidy(article["ArticleTitle"]), F.lit("")), F.concat(F.lit("PubMed record "), pmid)).alias("title"),
        F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/")).alias("source_url"),
        F.coalesce(citation_date(F.get(article["ArticleDate"], 0)), citation_date(article["Journal"]["JournalIssue"]["PubDate"])).alias("publication_date"),
        F.coalesce(citation_date(F.col("MedlineCitation.DateRevised")), citation_date(F.col("MedlineCitation.DateCompleted"))).alias("revised_date"),
        F.coalesce(article["Journal"]["Title"], article["Journal"]["ISOAbbreviation"]).alias("journal"), article["Journal"]["ISSN"]["_VALUE"].alias("issn"),
        article["Journal"]["JournalIssue"]["Volume"].alias("volume"), article["Journal"]["JournalIssue"]["Issue"].alias("issue"),
        F.coalesce(F.filter(F.transform(article["AuthorList"]["Author"], name), lambda a: a.isNotNull()), empty).alias("authors"), F.coalesce(mesh, empty).alias("mesh_terms"),
        F.coalesce(F.transform(F.col("MedlineCitation.KeywordList.Keyword"), lambda k: k["_VALUE"]), empty).alias("keywords"), first_id("doi").alias("doi"), first_id("pmc").alias("pmcid"),
        article["Abstract"]["AbstractText"].alias("_abstract"),
    )
    label = lambda p: F.nullif(F.trim(F.coalesce(p["_Label"], p["_NlmCategory"], F.lit(""))), F.lit(""))
    block = lambda path, text, kind: F.struct(path.alias("heading_path"), text.alias("text"), F.lit(kind).alias("kind"))
    parts = F.transform(F.filter("_abstract", lambda p: F.length(_tidy(p["_VALUE"])) > 0), lambda p: block(F.when(label(p).isNull(), F.array(F.lit("Abstract"))).otherwise(F.array(F.lit("Abstract"), label(p))), _tidy(p["_VALUE"]), "paragraph"))
    line = lambda title, c: F.when(F.size(c) > 0, F.concat(F.lit(title), F.array_join(c, "; ")))
    terms = F.concat_ws("\n", line("MeSH terms: ", F.col("mesh_terms")), line("Keywords: ", F.col("keywords")))
    none = F.slice(F.array(block(F.array(F.lit("")), F.lit(""), "paragraph")), 1, 0)
    found = F.concat(F.coalesce(parts, none), F.when(terms == "", none).otherwise(F.array(block(F.array(F.lit("Indexing")), terms, "metadata"))))
    cited = F.concat_ws(". ", "title", F.concat(F.lit("Journal: "), F.col("journal")), line("Authors: ", F.col("authors")), F.concat(F.lit("Publication date: "), F.col("publication_date")))
    found = F.when(F.size(found) > 0, found).otherwise(F.array(block(F.array(F.lit("Citation")), cited, "metadata")))
    return docs.drop("_abstract"), docs.select("document_id", F.posexplode(found).alias("block_index", "b")).select("document_id", "block_index", "b.*")


def read_citations(spark: SparkSession, path: str, corpus: str = "pubmed") -> tuple[DataFrame, DataFrame]:
    return citations(read_xml(spark, path, "PubmedArticle", CITATION), corpus)


# ---- questions and answers

POST = (
    "_Id BIGINT, _PostTypeId INT, _ParentId BIGINT, _AcceptedAnswerId BIGINT, _Score BIGINT, _ViewCount BIGINT, _AnswerCount BIGINT, _Title STRING, _Body STRING, _Tags STRING, "
    "_OwnerUserId BIGINT, _OwnerDisplayName STRING, _CreationDate STRING, _LastEditDate STRING, _LastActivityDate STRING, _ContentLicense STRING"
)
USER = "_Id BIGINT, _DisplayName STRING"
SKIPPED_POSTS = [1_000_000_001, 1_000_000_010]  # fixed values: artificial rows of the public dumps
_PARSED = T.ArrayType(BLOCK)


def _read_html(values: pd.Series) -> pd.Series:
    return values.map(lambda v: [b._asdict() for b in parse_html(v or "", "").blocks])


html_blocks = column_in_slices(_read_html, _PARSED)


def posts(rows: DataFrame, users: DataFrame, corpus: str) -> DataFrame:
    """Questions and the answers that stay, as documents; a post's own author name goes before the user's."""
    known = rows.where(~F.col("_Id").isin(SKIPPED_POSTS)).withColumn("kind", F.when(F.col("_PostTypeId") == 1, "question").when(F.col("_PostTypeId") == 2, "answer")).where("kind IS NOT NULL")
    thin = known.select(F.col("_Id").alias("id"), "kind", F.col("_ParentId").alias("parent_id"), F.col("_AcceptedAnswerId").alias("accepted_id"), F.col("_Score").alias("score"))
    answers = retain_answers(thin).select("id", "parent_id", "accepted", "place")
    questions = thin.where("kind = 'question'").select("id", F.col("id").alias("parent_id"), F.lit(False).alias("accepted"), F.lit(0).alias("place"))
    titles = known.where("kind = 'question'").select(F.col("_Id").alias("parent_id"), F.col("_Title").alias("title"))
    named = known.drop("kind").join(answers.unionByName(questions).withColumnRenamed("id", "_Id"), "_Id").join(titles, "parent_id")
    authors = users.select(F.col("_Id").alias("_OwnerUserId"), F.col("_DisplayName").alias("_user"))
    return named.join(authors, "_OwnerUserId", "left").select(
        F.concat(F.lit(corpus + ":post:"), F.col("_Id").cast("string")).alias("document_id"), F.col("_Id").alias("post_id"), "parent_id", "place", "accepted", F.col("_Score").alias("score"), "title",
        F.coalesce("_OwnerDisplayName", "_user").alias("author"), F.filter(F.split(F.regexp_replace("_Tags", "[<>|]+", " "), " "), lambda t: t != "").alias("tags"), F.coalesce("_LastEditDate", "_LastActivityDate", "_CreationDate").alias("source_timestamp"), F.col("_ContentLicense").alias("license"), F.col("_Body").alias("body"),
    )


def read_posts(spark: SparkSession, folder: str, corpus: str) -> DataFrame:
    return posts(read_xml(spark, f"{folder}/Posts.xml", "row", POST), read_xml(spark, f"{folder}/Users.xml", "row", USER), corpus)


# ---- registries and guides

_RECORD = T.ArrayType(T.StructType([T.StructField("registry", T.ArrayType(T.StringType())), T.StructField("record_id", T.StringType()), T.StructField("text", T.StringType())]))


def registries(files: DataFrame, content: str = "content") -> DataFrame:
    """One row for each record of registry XML files: relative, registry, record_id, text."""
    ship(files.sparkSession)

    def read(values: pd.Series) -> pd.Series:
        return values.map(lambda v: [{"registry": path, "record_id": record, "text": render_record(fields)} for path, record, fields in registry_records(v)])

    run = column_in_slices(read, _RECORD, 1)
    return files.select("relative", F.explode(run(F.col(content).cast("string"))).alias("r")).select("relative", "r.*")
