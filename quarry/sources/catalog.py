"""What a site or a catalog offers, from pages that are there already: links with labels, selection of assets, the pages
that can be reached from one, and the check of files against a list of their hashes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import unquote, urldefrag, urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.runtime import remove, ship, stored_at
from quarry.sources.files import canonical_url, within

MOST_ROUNDS = 100


class _Anchors(HTMLParser):
    """Anchors in order as [target, words of the label]; what stands in comments and scripts is none."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, list[str]]] = []
        self.inside = False

    def handle_starttag(self, tag, attrs):
        target = dict(attrs).get("href")
        if target and (tag == "area" or (tag == "a" and not self.inside)):
            self.found.append((target, []))
            self.inside = tag == "a"

    def handle_data(self, data):
        if self.inside:
            self.found[-1][1].append(data)

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "a"


def anchors(html: str) -> list[tuple[str, str]]:
    """(target, label) of every anchor, in order."""
    parser = _Anchors()
    parser.feed(html)
    parser.close()
    return [(target, " ".join(" ".join(words).split())) for target, words in parser.found]


def page_anchors(pages: DataFrame) -> DataFrame:
    """url, place, href (as it stands), target (absolute, without its fragment) and label of the anchors of ``pages`` (url,
    html)."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
                for place, (target, label) in enumerate(anchors(html or "")):
                    rows.append((url, place, target, _absolute(url or "", target), label))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()), strict=True)], names=["url", "place", "href", "target", "label"])

    return pages.select("url", "html").mapInArrow(run, "url string, place int, href string, target string, label string")


def _absolute(base: str, target: str) -> str | None:
    try:
        return urldefrag(urljoin(base, target))[0]
    except ValueError:  # no address
        return None


def relative_asset(prefix: str, target: str) -> str | None:
    """The path of an asset below the prefix, none for another address; one that is not safe is an error."""
    if not target.startswith(prefix) or "?" in target:
        return None
    path = unquote(target[len(prefix) :])
    if not path or "\\" in path or any(part in ("", ".", "..") for part in path.split("/")):
        raise ValueError(f"{target} has an unsafe path")
    return path


def select_assets(links: list[tuple[str, str]], prefix: str, pattern: str, least: int = 1, most: int = 10_000, excluded: tuple[str, ...] = ()) -> list[tuple[str, str, str]]:
    """(path, target, title) of a catalog page's assets that the whole pattern meets, each once, by path. A number out of
    bounds, two addresses for one path, or an exclusion that meets nothing is an error."""
    found: dict[str, tuple[str, str]] = {}
    missing = set(excluded)
    for target, label in links:
        path = relative_asset(prefix, target)
        if path is None or not re.fullmatch(pattern, path):
            continue
        if path in missing or path in excluded:
            missing.discard(path)
            continue
        if path in found and found[path][0] != target:
            raise ValueError(f"{path} has two addresses")
        found.setdefault(path, (target, label))
    if missing:
        raise ValueError(f"exclusions without an asset: {', '.join(sorted(missing))}")
    if not least <= len(found) <= most:
        raise ValueError(f"{len(found)} assets; {least} to {most} are expected")
    return [(path, target, label or path.rpartition("/")[2]) for path, (target, label) in sorted(found.items())]


def reachable(pages: DataFrame, seed: str, prefix: str) -> DataFrame:
    """url and depth of the pages below a prefix that links lead to from the seed: rounds of joins with the links and
    anti-joins with what was met before; each round is written to the shared folder."""
    spark = pages.sparkSession
    links = page_anchors(pages).select(canonical_url(F.col("url")).alias("url"), canonical_url(F.col("target")).alias("target"))
    links, _ = stored_at(links.where(within(F.col("target"), prefix) & (F.col("url") != F.col("target"))).distinct(), "site-links")
    there = pages.select(canonical_url(F.col("url")).alias("url")).where("url IS NOT NULL").distinct()
    met, path = stored_at(there.join(spark.createDataFrame([(seed, 0)], "url string, depth int"), "url"), "site-met")
    for depth in range(1, MOST_ROUNDS):
        front = met.where(F.col("depth") == depth - 1).select("url")
        new = links.join(front, "url", "left_semi").select(F.col("target").alias("url")).distinct()
        new = new.join(there, "url", "left_semi").join(met.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth))
        last = path
        grown, path = stored_at(met.unionByName(new), "site-met")
        before, met = met, grown
        if met.count() == before.count():
            remove(spark, last)
            return met
        remove(spark, last)
    raise ValueError("the site is deeper than the rounds allow")


_CHECKSUM = r"^\s*([0-9a-fA-F]{40})\s+\*?(\S.*?)\s*$"


def checksum_list(lines: DataFrame) -> DataFrame:
    """name and sha1 of a list's lines (value); blank lines and comments are passed, others must be entries, and a name
    has one hash."""
    kept = lines.where(~F.col("value").rlike(r"^\s*(#|$)"))
    bad = kept.where(~F.col("value").rlike(_CHECKSUM)).first()
    if bad:
        raise ValueError(f"no entry of a list of hashes: {bad['value']!r}")
    found = kept.select(F.regexp_extract("value", _CHECKSUM, 2).alias("name"), F.lower(F.regexp_extract("value", _CHECKSUM, 1)).alias("sha1")).distinct()
    twice = found.groupBy("name").count().where("count > 1").first()
    if twice:
        raise ValueError(f"{twice['name']} has two hashes")
    return found


def checked_files(files: DataFrame, expected: DataFrame) -> DataFrame:
    """name, bytes, sha1 and state (verified, differs, unlisted, missing) of ``files`` (name, content) against a list."""
    actual = files.select("name", F.octet_length("content").cast("long").alias("bytes"), F.sha1(F.col("content").cast("binary")).alias("actual"))
    both = actual.join(expected, "name", "full_outer")
    state = F.when(F.col("actual").isNull(), "missing").when(F.col("sha1").isNull(), "unlisted").when(F.col("actual") == F.col("sha1"), "verified").otherwise("differs")
    return both.select("name", "bytes", F.coalesce("actual", "sha1").alias("sha1"), state.alias("state"))
