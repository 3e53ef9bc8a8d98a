"""URL filters by a sort-merge range join.

A host's labels are reversed into a canonical key, ``com.example.www.``; a rule's host becomes the interval of all
keys that begin with its own key, that is, the host and its subdomains. URLs and rules are dealt by key ranges: the
range bounds come from a bounded sample of keys, a key that fills several ranges is spread over them by page, and a
rule goes to every range that its interval meets. Each task sorts its range by key and sweeps it once, keeping a
stack of the rule hosts that are active; these nest, so the top is the most specific. Under each active host the
longest rule path that the URL's path begins with is looked up by its length; of all fits the longest rule wins
(of equally long ones the one with the longer host, then block before allow).

Cases: a null url, or one without ``://``, has an empty host and path and no rule; a path may be empty; repeated rows
are judged each; very long URLs are read whole; of rules given twice one is used, block before allow; an empty table
or an empty list of rules is fine; extra columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.runtime import ship, shuffle_partitions

ALLOW, BLOCK = "allow", "block"
BOUND_SAMPLE = 8192  # keys at most that the range bounds are taken from

RULES = [
    ("com", "/en/", BLOCK),
    ("example.com", "/en/7", ALLOW),
    ("net", "/de/", ALLOW),
    ("example.net", "/de/8", BLOCK),
    ("org", "/es/", BLOCK),
]


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z as a-z."""
    rest = F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(of: Column) -> Column:
    return F.when(of == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(of, "\\.", -1)), "."), F.lit(".")))


def key_of(name: str) -> bytes:
    return (".".join(reversed(name.split("."))) + ".").encode()


def _bounds(urls: DataFrame, ranges: int) -> list[bytes]:
    """Keys that part the rows evenly; a common key may come several times. Only the split of the work depends on
    the sample."""
    n = urls.count()
    keys = urls.select("key").sample(min(1.0, BOUND_SAMPLE / 2 / max(n, 1)), seed=7).limit(BOUND_SAMPLE).collect()
    keys = sorted(r["key"].encode() for r in keys)
    return [keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else []


def _dealt_urls(bounds: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = []
            for key, salt in zip(batch.column("key").to_pylist(), batch.column("salt").to_pylist(), strict=True):
                key = key.encode()
                lo, hi = bisect.bisect_left(bounds, key), bisect.bisect_right(bounds, key)
                at.append(lo + salt % (hi - lo + 1))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns], names=["range", *batch.schema.names])

    return run


def _dealt_rules(bounds: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                key = row["key"].encode()
                lo, hi = bisect.bisect_left(bounds, key), bisect.bisect_left(bounds, key[:-1] + b"/")  # "." + 1 is "/"
                out += [{"range": k, **row} for k in range(lo, hi + 1)]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("range", pa.int32()), *((f.name, f.type) for f in batch.schema)]))

    return run


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by range, key, and rules first."""
    stack: list[tuple[str, str, dict[str, str], list[int]]] = []  # key, host, path to verdict, path lengths
    here = None
    for batch in batches:
        rules, verdicts = [], []
        columns = [batch.column(n).to_pylist() for n in ("range", "key", "is_rule", "host", "path", "action")]
        for at, key, is_rule, of, way, action in zip(*columns, strict=True):
            if at != here:
                here, stack = at, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if is_rule:
                if not stack or stack[-1][0] != key:
                    stack.append((key, of, {}, []))
                ways = stack[-1][2]
                if way not in ways:
                    stack[-1][3].append(len(way))
                    stack[-1][3][:] = sorted(set(stack[-1][3]), reverse=True)
                ways[way] = BLOCK if BLOCK in (action, ways.get(way)) else ALLOW
                continue
            best = None
            for _, name, ways, lengths in stack:
                for n in lengths:
                    if n <= len(way) and (said := ways.get(way[:n])):
                        best = max(best or (-1,), (len(name) + n, len(name), said == BLOCK, name + way[:n], said))
                        break
            rules.append(best[3] if best else None)
            verdicts.append(best[4] if best else ALLOW)
        kept = batch.filter(pa.array([not x for x in columns[2]]))
        yield pa.RecordBatch.from_arrays([kept.column("page_id"), kept.column("host"), kept.column("path"), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict for every page; ``rules`` has host, path and action."""
    spark = pages.sparkSession
    ship(spark)
    n = shuffle_partitions(spark)
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    urls = urls.select("page_id", "host", "path", host_key(F.col("host")).alias("key"), (F.monotonically_increasing_id() % (1 << 20)).cast("int").alias("salt"))
    rules = rules.select("host", "path", "action", host_key(F.col("host")).alias("key"))
    bounds = _bounds(urls, 2 * n)
    fields = "range int, {}host string, path string, {}key string"
    left = urls.mapInArrow(_dealt_urls(bounds), fields.format("page_id long, ", "") + ", salt int").drop("salt").withColumn("is_rule", F.lit(False))
    right = rules.mapInArrow(_dealt_rules(bounds), fields.format("", "action string, ")).withColumn("is_rule", F.lit(True))
    both = left.unionByName(right, allowMissingColumns=True).repartition(n, "range")
    swept = both.sortWithinPartitions("range", "key", F.desc("is_rule"))
    return swept.mapInArrow(_swept, "page_id long, host string, path string, rule string, verdict string")


def report(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return judge(pages, pages.sparkSession.createDataFrame(rules, "host string, path string, action string"))


def _sql() -> str:
    values = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)
    return f"""
WITH u AS (
  SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') AS raw,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u
), r(rhost, rpath, action) AS (VALUES {values}),
f AS (
  SELECT p.page_id, p.host, p.path, rhost || rpath AS rule, action,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC, action DESC) AS k
  FROM p LEFT JOIN r ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath)
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM f WHERE k = 1
"""


SQL = _sql()
