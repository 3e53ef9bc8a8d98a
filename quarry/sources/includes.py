"""Files that include others: Markdown's ``[!INCLUDE [title](path)]`` lines, resolved by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.runtime import stored

LINE = r"(?im)^\s*\[!INCLUDE\s+\[[^\]]*\]\(([^)]+)\)\]\s*$"
MOST_DEPTH = 20


def _resolved(base, target):
    """A relative path from the folder of another; ``.`` and ``a/..`` fall away whatever their number, and one that
    leaves the tree begins with ``..``."""
    folder = F.split(F.regexp_extract(base, r"^(.*/)?[^/]*$", 1), "/")
    parts = F.filter(F.concat(folder, F.split(target, "/")), lambda p: ~p.isin("", "."))
    above = lambda done: (F.size(done) > 0) & (F.element_at(done, -1) != "..")
    folded = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda done, p: F.when((p == "..") & F.when(F.size(done) > 0, above(done)).otherwise(F.lit(False)), F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(p))),
    )
    return F.array_join(folded, "/")


#: An empty XInclude element with a local file; its text takes the element's place, without its XML declaration.
XINCLUDE = r"""(?s)<(?:\w+:)?include\s[^>]*?href=["']([^"'#:]+)["'][^>]*?(?:/>|>.*?</(?:\w+:)?include>)"""


def expand_xincludes(files: DataFrame) -> DataFrame:
    """``files`` (relative, text) of XML with local includes resolved; the text of a file may be included several times."""
    bare = files.withColumn("text", F.regexp_replace("text", r"^\s*<\?xml[^>]*\?>\s*|<!DOCTYPE[^>\[]*>\s*", ""))
    return expand_includes(bare, XINCLUDE)


def expand_includes(files: DataFrame, pattern: str = LINE) -> DataFrame:
    """``files`` (relative, text) with every include line replaced by the included text. An include that leaves the
    tree, that is missing, or that closes a circle is an error."""
    now = files.withColumn("seen", F.array("relative"))
    bodies = files.select(F.col("relative").alias("target"), F.col("text").alias("body"))
    for _ in range(MOST_DEPTH):
        first = now.withColumn("named", F.regexp_extract("text", pattern, 1))
        open_ = first.where("named <> ''").withColumn("target", _resolved(F.element_at("seen", -1), F.col("named")))
        if open_.limit(1).count() == 0:
            return now.select("relative", "text")
        joined = open_.join(bodies, "target", "left")
        bad = joined.where(F.col("body").isNull() | F.array_contains("seen", F.col("target"))).select("relative", "target").first()
        if bad:
            raise ValueError(f"{bad['relative']} includes {bad['target']}, which is outside, missing or includes it")
        line = F.regexp_extract("text", pattern, 0)
        put = joined.withColumn("text", F.replace("text", line, F.concat(F.lit("\n"), F.trim("body"), F.lit("\n"))))
        deeper = F.when(F.col("body").rlike(pattern), F.concat("seen", F.array("target"))).otherwise(F.col("seen"))
        now = stored(first.where("named = ''").drop("named").unionByName(put.withColumn("seen", deeper).select("relative", "text", "seen")), "includes")
    raise ValueError("includes nest too deeply")
