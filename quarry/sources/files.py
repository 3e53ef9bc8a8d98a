"""Scans of files: JSON lines, trees of documentation, and XML dumps; and the choice of a parser."""

from __future__ import annotations

import re
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.runtime import ship
from quarry.schema import BLOCK
from quarry.sources import golang, markup, xml_docs

# Suffixes of documentation, and folders and files that hold none.
SUFFIXES = {
    ".html": markup.parse_html, ".htm": markup.parse_html, ".xhtml": markup.parse_html, ".md": markup.parse_markdown, ".mdx": markup.parse_markdown, ".markdown": markup.parse_markdown,
    ".rst": markup.parse_rst, ".adoc": markup.parse_asciidoc, ".asciidoc": markup.parse_asciidoc, ".pod": markup.parse_pod, ".go": golang.parse_go, ".txt": markup.parse_text, ".man": markup.parse_man, ".roff": markup.parse_man,
    ".cnxml": xml_docs.parse_cnxml, ".wiki": markup.parse_wiki,
}
IGNORED_FOLDERS = [".git", ".hg", ".svn", "node_modules", "_static", "_sources"]
IGNORED_FILES = ["search.html", "genindex.html", "py-modindex.html"]


def parser_for(path: str, text: str):
    """By suffix, with generated endings (``.md.in``, ``.html.en``) looked through; manual pages, requests for
    comments and XML formats by what they begin with."""
    suffixes = [s.lower() for s in PurePosixPath(path).suffixes]
    head = text[:12_000]
    if suffixes[-1:] == [".xml"]:
        return xml_docs.parse_nginx_xml if re.search(r"<(?:article|module)\b[^>]*\bname=", head) else xml_docs.parse_cnxml if "cnx" in head else xml_docs.parse_docbook
    known = next((SUFFIXES[s] for s in reversed(suffixes[-2:]) if s in SUFFIXES), None)
    if known in (None, markup.parse_text):
        if re.search(r"(?m)^\.(?:TH|Dd|Dt)\s", head):
            return markup.parse_man
        if markup.RFC_MARK.search(head):
            return markup.parse_rfc
        if suffixes and re.fullmatch(r"\.\d[a-z]*", suffixes[-1]):
            return markup.parse_man
    return known or markup.parse_text


def parse(path: str, text: str) -> markup.Parsed:
    parser, stem = parser_for(path, text), PurePosixPath(path).stem
    return parser(text, stem, path) if parser is golang.parse_go else parser(text, stem)


def decode(raw: bytes) -> str:
    """UTF-8, with or without a mark, else Windows' Latin letters, else Latin-1."""
    for encoding in ("utf-8-sig", "cp1252"):
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    return raw.decode("latin-1")


PARSED = T.StructType([T.StructField("title", T.StringType()), T.StructField("blocks", T.ArrayType(BLOCK)), T.StructField("format", T.StringType()), T.StructField("error", T.StringType())])


def parsed_column(spark: SparkSession, path: Column, content: Column) -> Column:
    """(title, blocks, format, error) of each text or binary file; a file that cannot be parsed has its error."""
    ship(spark)

    @F.pandas_udf(PARSED)
    def run(paths: pd.Series, contents: pd.Series) -> pd.DataFrame:
        rows = []
        for name, raw in zip(paths, contents, strict=True):
            try:
                text = "" if raw is None else raw if isinstance(raw, str) else decode(bytes(raw))
                found = parse(name or "", text)
                rows.append((found.title, [b._asdict() for b in found.blocks], found.format, None))
            except (ValueError, RecursionError) as error:
                rows.append((None, [], None, str(error)[:300]))
        return pd.DataFrame(rows, columns=["title", "blocks", "format", "error"])

    return run(path, content)


def read_json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Blank lines are skipped; a malformed line is an error when it is read. zstd files by their suffix."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_tree(spark: SparkSession, root: str, include: str = ".*", exclude: str | None = None) -> DataFrame:
    """Documentation files below a folder: path, relative, content, sha256; sorted listings are up to the caller."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    prefix = re.escape(re.sub(r"^file:/+", "/", root.rstrip("/")))
    relative = F.regexp_extract("path", f"{prefix}/(.*)$", 1)
    known = "|".join(re.escape(s) for s in (*SUFFIXES, ".xml", ".in", ".en"))
    kept = relative.rlike(f"(?i)(?:{known}|\\.\\d[a-z]*)$") & relative.rlike(include) & ~relative.rlike(f"(?:^|/)(?:{'|'.join(map(re.escape, IGNORED_FOLDERS))})/")
    kept = kept & ~relative.rlike(f"(?i)(?:^|/)(?:{'|'.join(map(re.escape, IGNORED_FILES))})$")
    if exclude:
        kept = kept & ~relative.rlike(exclude)
    return files.where(kept).select("path", relative.alias("relative"), "content", F.sha2("content", 256).alias("sha256"))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """(relative, length, sha256) of every file, to be held against a stored inventory."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    prefix = re.escape(re.sub(r"^file:/+", "/", root.rstrip("/")))
    return files.select(F.regexp_extract("path", f"{prefix}/(.*)$", 1).alias("relative"), "length", F.sha2("content", 256).alias("sha256"))


def compare_inventories(stored: DataFrame, found: DataFrame) -> DataFrame:
    """Files that are missing, new or changed."""
    a, b = stored.select("relative", F.col("sha256").alias("_a")), found.select("relative", F.col("sha256").alias("_b"))
    state = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "new").when(F.col("_a") != F.col("_b"), "changed")
    return a.join(b, "relative", "full_outer").select("relative", state.alias("state")).where("state IS NOT NULL")


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    """Rows of a large XML file; compressed files by their suffix."""
    return spark.read.format("xml").option("rowTag", row_tag).option("mode", "FAILFAST").schema(schema).load(path)


# ---- links


def markdown_links(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\[[^\]]*\]\(([^)\s]+)"), F.lit(1))


def canonical_url(url: Column) -> Column:
    """Scheme and host in small letters, no query, no fragment, no ``index.html``; null if it is no http address."""
    match = r"(?i)^(https?)://([^/?#]+)([^?#]*)"
    host = F.lower(F.concat(F.regexp_extract(url, match, 1), F.lit("://"), F.regexp_extract(url, match, 2)))
    path = F.regexp_replace(F.regexp_extract(url, match, 3), "(?i)/index\\.html$", "/")
    return F.when(url.rlike(match), F.concat(host, F.when(path == "", "/").otherwise(path)))


def within(url: Column, prefix: str) -> Column:
    """Pages below a prefix: no file of another kind than HTML."""
    last = F.regexp_extract(url, r"/([^/]*)$", 1)
    return url.startswith(prefix) & (~last.contains(".") | last.rlike(r"(?i)\.x?html?$"))
