"""Command line: ``python -m quarry build|query|verify|plan|evaluate``, on tables of Parquet."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from quarry import options
from quarry.operators import corpus
from quarry.plans import publish
from quarry.plans.evaluate import evaluate_collection
from quarry.session import Collection, Corpus


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quarry", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build", help="publish the inverted index of a table of chunks")
    build.add_argument("chunks")
    build.add_argument("root")
    for name, words in (("query", "search corpora"), ("evaluate", "a suite of cases against corpora")):
        one = commands.add_parser(name, help=words)
        one.add_argument("asked", help="the query" if name == "query" else "the suite's JSON file")
        one.add_argument("--chunks", action="append", required=True, metavar="CORPUS=PATH")
        one.add_argument("--index", action="append", required=True, metavar="CORPUS=PATH")
        one.add_argument("--query-alias", action="append", default=[], metavar="CORPUS=A=>B")
        one.add_argument("--query-route", action="append", default=[], metavar="CORPUS=REGEX")
        one.add_argument("--limit", type=int, default=8)
        one.add_argument("--mode", default="and")
    verify = commands.add_parser("verify", help="check a published index against itself")
    verify.add_argument("root")
    verify.add_argument("--smoke", action="append", default=[], help="a query that must find something")
    plan = commands.add_parser("plan", help="what an update changes: two tables with document_id and content_hash")
    plan.add_argument("old")
    plan.add_argument("new")
    return top


def _collection(spark: SparkSession, given: argparse.Namespace) -> Collection:
    chunks, indexes = options.mapping(given.chunks, "--chunks"), options.mapping(given.index, "--index")
    if set(chunks) != set(indexes):
        raise ValueError("every corpus needs --chunks and --index")
    names, patterns = options.aliases(given.query_alias, list(chunks)), options.routes(given.query_route, list(chunks))
    return Collection(spark, [Corpus(n, spark.read.parquet(path), publish.open_index(spark, indexes[n]), aliases=names[n], pattern=patterns.get(n)) for n, path in chunks.items()])


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    given = _parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("quarry").getOrCreate()
    if given.command == "build":
        said = {"generation": publish.publish_index(given.root, spark.read.parquet(given.chunks))}
    elif given.command == "query":
        said = {"results": [r.asDict(True) for r in _collection(spark, given).search(given.asked, given.limit, given.mode).collect()]}
    elif given.command == "evaluate":
        with open(given.asked, encoding="utf-8") as suite:
            said = evaluate_collection(json.load(suite), _collection(spark, given))
    elif given.command == "verify":
        said = {"problems": publish.verify_index(spark, given.root, given.smoke)}
    else:
        old, new = (spark.read.parquet(p) for p in (given.old, given.new))
        said = {"changes": [r.asDict() for r in corpus.update_summary(corpus.update_plan(old, new)).orderBy("change").collect()]}
    print(json.dumps(said, ensure_ascii=False, default=str))
    return 1 if said.get("problems") else 0


if __name__ == "__main__":
    sys.exit(main())
