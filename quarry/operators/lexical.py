"""The inverted index as tables, and batches of AND, OR and phrase queries ranked by field-weighted BM25.

The index is three frames: ``postings(term, row_id, field, tf, positions)``, ``lengths(row_id, dl)`` and one row of
corpus figures. A batch of queries is one plan: query terms meet the postings by term, sums are made per query and
row, and the best rows of each query are kept with a ranking window, which Spark cuts short inside each task.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.text import technical_normalized, technical_plain, tokens, tokens_plain
from quarry.runtime import ship, shuffle_partitions, stored

# The ranking function's parameters and the weights of the fields.
K1, B, LEAST_IDF = 1.2, 0.75, 1e-6
WEIGHTS = {"title": 5.0, "heading": 2.0, "text": 1.0, "technical": 2.0}
WEIGHTS_V1 = {"title": 5.0, "heading": 2.0, "text": 1.0}
# Words of a question that no passage need hold.
STOP_WORDS = (
    "a", "about", "an", "are", "be", "been", "being", "did", "do", "does", "how", "is", "instructions", "me", "of",
    "preparation", "prepare", "preparing", "recipe", "tell", "the", "was", "were", "what", "when", "where", "which",
    "who", "why",
)
MOST_TERMS = 1 << 17  # terms of one block of queries: what is sent to every task
MOST_PAIRS = 1 << 19  # postings of a part, or pairs of a query and a row that are summed in it
MODES = ("and", "or", "phrase", "exact")


@dataclass(frozen=True)
class QueryPlan:
    query: str
    mode: str
    terms: tuple[str, ...]
    technical: bool


def plan_query(query: str, mode: str = "and") -> QueryPlan:
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is none of {', '.join(MODES)}")
    technical = technical_plain(query)
    if technical:
        terms = technical.split()
    else:
        terms = [t.casefold() for t in re.findall(r"[^\W_]+", query)]
    if not terms:
        raise ValueError("the query has no searchable term")
    if mode in ("and", "or"):
        terms = [t for t in terms if t not in STOP_WORDS] or terms
    return QueryPlan(query, mode, tuple(terms), bool(technical))


def plan_terms(query: Column) -> Column:
    """The planned terms of a plain query as an array, for batches; stop words go unless nothing is left."""
    stop = F.array(*map(F.lit, STOP_WORDS))
    every = tokens(query)
    kept = F.filter(every, lambda t: ~F.array_contains(stop, t))
    return F.when(F.size(kept) > 0, kept).otherwise(every)


def plan_queries(spark: SparkSession, queries: list[tuple[str, str, str]]) -> DataFrame:
    """(query_id, query, mode) to rows (query_id, mode, pos, term); the few queries are planned on the driver."""
    rows = []
    for query_id, query, mode in queries:
        plan = plan_query(query, mode)
        folded = [t for term in plan.terms for t in tokens_plain(term)]
        rows += [(query_id, "phrase" if mode == "exact" else mode, i, t) for i, t in enumerate(folded)]
    return spark.createDataFrame(rows, "query_id string, mode string, pos int, term string")


@dataclass(frozen=True)
class Index:
    postings: DataFrame
    lengths: DataFrame
    corpus: DataFrame

    def cache(self) -> Index:
        return Index(self.postings.cache(), self.lengths.cache(), self.corpus.cache())

    def store(self) -> Index:
        """Written to the shared folder and read again, so that no later step tokenises anew."""
        lengths = stored(self.lengths, "lengths")
        return Index(stored(self.postings, "postings"), lengths, corpus_figures(lengths))


def field_tokens(chunks: DataFrame, fields: dict[str, str | Column]) -> DataFrame:
    """(row_id, field, words): one row for each field of a chunk."""
    named = [F.struct(F.lit(name).alias("field"), tokens(F.col(c) if isinstance(c, str) else c).alias("words")) for name, c in fields.items()]
    return chunks.select("row_id", F.inline(F.array(*named)))


def build_index(chunks: DataFrame, fields: dict[str, str | Column] | None = None, terms: DataFrame | None = None, positions: bool = True) -> Index:
    """``chunks`` has row_id and the fields' columns; by default title, heading and text, and the technical names of all
    three. Only phrases need ``positions``. With ``terms``, for a batch of queries against chunks that have no stored
    index, other terms are merely counted: one pass over the texts gives the lengths of all rows and the postings of
    the batch, and is stored."""
    if fields is None:
        ship(chunks.sparkSession)
        everything = F.concat_ws(" ", "title", "heading", "text")
        chunks = chunks.withColumn("technical", technical_normalized(everything))
        fields = {name: name for name in WEIGHTS}
    found = field_tokens(chunks, fields)
    if terms is None:
        places = found.select("row_id", "field", F.posexplode("words").alias("pos", "term"))
        postings = places.groupBy("term", "row_id", "field").agg(*_gathered(positions))
        lengths = found.groupBy("row_id").agg(F.sum(F.size("words")).alias("dl"))
        return Index(postings, lengths, corpus_figures(lengths))
    places = found.select("row_id", "field", F.posexplode_outer("words").alias("pos", "word"))
    wanted = stored(terms.select("term").distinct(), "batch-terms")
    small = wanted.count() <= MOST_TERMS
    met = places.join(F.broadcast(wanted) if small else wanted, F.col("word") == F.col("term"), "left")
    counted = stored(met.groupBy("term", "row_id", "field").agg(*_gathered(positions)), "batch-postings")
    lengths = counted.groupBy("row_id").agg(F.sum("tf").alias("dl"))
    return Index(counted.where(F.col("term").isNotNull()), lengths, corpus_figures(lengths))


def _gathered(positions: bool) -> list[Column]:
    known = F.when(F.col("term").isNotNull(), F.col("pos"))  # words that no query asks for have no places
    return [F.count("pos").alias("tf"), *([F.array_sort(F.collect_list(known)).alias("positions")] if positions else [])]


def corpus_figures(lengths: DataFrame) -> DataFrame:
    return lengths.agg(F.count(F.lit(1)).alias("n"), (F.sum("dl") / F.count(F.lit(1))).alias("avgdl"))


def _weight(field: Column, weights: dict[str, float]) -> Column:
    column = F.lit(0.0)
    for name, w in weights.items():
        column = F.when(field == name, w).otherwise(column)
    return column


def _score(idf: Column, f: Column) -> Column:
    return -idf * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))


def _idf(n_rows: Column, n: Column) -> Column:
    raw = F.log((n_rows - n + 0.5) / (n + 0.5))
    return F.when(raw <= 0, LEAST_IDF).otherwise(raw)


def _anchored(per_row: DataFrame, spread: DataFrame, wanted: DataFrame) -> DataFrame:
    """(query_id, row_id) of the rows that hold a query's rarest term: all that can hold all of its terms."""
    rare = wanted.join(spread, "term", "left").groupBy("query_id").agg(F.min_by("term", F.struct(F.coalesce("df", F.lit(0)), "term")).alias("term"))
    return per_row.select("term", "row_id").join(rare, "term").select("query_id", "row_id").distinct()


def _parts(index: Index, wanted: DataFrame) -> int:
    """How many parts rows are dealt into, so that a part has MOST_PAIRS postings, or pairs of a query and a row that
    it may find, on average."""
    sizes = index.postings.join(wanted.select("term").distinct(), "term").groupBy("term").agg(F.count(F.lit(1)).alias("held"))
    sizes = stored(sizes, "term-sizes")
    per_query = wanted.join(sizes, "term", "left").groupBy("query_id", "mode").agg(F.sum("held").alias("every"), F.min(F.coalesce("held", F.lit(0))).alias("rarest"))
    found = per_query.crossJoin(F.broadcast(index.corpus)).agg(F.sum(F.when(F.col("mode") == "and", F.col("rarest")).otherwise(F.least("every", "n"))).alias("pairs"))  # one row
    row = found.crossJoin(sizes.agg(F.sum("held").alias("postings"))).first()
    return -(-max(row["pairs"] or 0, row["postings"] or 0) // MOST_PAIRS)


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """By row. A number that is given keeps Spark from joining parts again, whose pairs are many more than their
    bytes; what is met with them is then dealt alike, if the number is not the lesser one."""
    return rows.repartition("row_id") if parts <= 1 else rows.repartition(max(parts, shuffle_partitions(rows.sparkSession)), "row_id")


def match_terms(index: Index, terms: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """AND and OR queries: (query_id, row_id, raw_score). ``terms`` has query_id, mode, pos, term; a term given twice
    counts twice. Lower is better. For AND, only rows with the rarest term are looked at; for OR, blocks of query terms
    go to every row."""
    wanted = terms.where(F.col("mode").isin("and", "or"))
    modes = {r["mode"]: r["n"] for r in wanted.groupBy("mode").agg(F.count(F.lit(1)).alias("n")).collect()}  # one or two rows
    if not modes:
        return wanted.select("query_id").limit(0).select("query_id", F.lit(None).cast(index.lengths.schema["row_id"].dataType).alias("row_id"), F.lit(0.0).alias("raw_score"))
    # dealt by row once: frequencies and the sums of all queries are then made where the row lies
    per_row = (
        _dealt(index.postings.join(wanted.select("term").distinct(), "term").select("term", "row_id", "field", "tf"), _parts(index, wanted))
        .groupBy("term", "row_id")
        .agg(F.sum(_weight(F.col("field"), weights) * F.col("tf")).alias("f"))
    )
    spread = per_row.groupBy("term").agg(F.count("f").alias("df"))  # of f, so that it reads the same shuffle
    sizes = wanted.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_terms"))
    weighted = wanted.join(spread, "term").join(sizes, "query_id").crossJoin(F.broadcast(index.corpus)).select("query_id", "mode", "n_terms", "term", "avgdl", _idf(F.col("n"), F.col("df")).alias("idf"))  # the corpus is one row
    known = per_row.join(index.lengths, "row_id")
    score = F.sum(_score(F.col("idf"), F.col("f"))).alias("raw_score")
    found = []
    if modes.get("and"):
        every = wanted.where("mode = 'and'")
        candidates = _anchored(per_row, spread, every.select("query_id", "term"))
        hits = known.join(candidates, "row_id").join(weighted.where("mode = 'and'"), ["query_id", "term"])
        whole = hits.groupBy("query_id", "n_terms", "row_id").agg(score, F.count(F.lit(1)).alias("matched"))
        found.append(whole.where("matched = n_terms").select("query_id", "row_id", "raw_score"))
    blocks = max(1, -(-modes.get("or", 0) // MOST_TERMS))
    for k in range(blocks if modes.get("or") else 0):
        block = weighted.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == k).where("mode = 'or'")
        found.append(known.join(F.broadcast(block), "term").groupBy("query_id", "row_id").agg(score).select("query_id", "row_id", "raw_score"))
    return functools.reduce(DataFrame.unionByName, found)


def match_phrases(index: Index, terms: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """Phrase queries: the terms next to each other in one field count as one term. Positions are compared only in rows
    that hold the rarest term."""
    wanted = terms.where(F.col("mode") == "phrase").select("query_id", F.col("pos").alias("at"), "term")
    sizes = wanted.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_terms"))
    postings = index.postings.join(wanted.select("term").distinct(), "term")
    spread = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    candidates = _anchored(postings, spread, wanted.select("query_id", "term"))
    near = postings.join(candidates, "row_id").join(wanted, ["query_id", "term"])
    places = near.select("query_id", "row_id", "field", F.explode("positions").alias("p"), "at")
    starts = places.groupBy("query_id", "row_id", "field", (F.col("p") - F.col("at")).alias("start")).agg(F.count(F.lit(1)).alias("met"))
    whole = starts.join(sizes, "query_id").where(F.col("met") == F.col("n_terms"))
    per_row = whole.groupBy("query_id", "row_id").agg(F.sum(_weight(F.col("field"), weights)).alias("f"))
    spread = per_row.groupBy("query_id").agg(F.count(F.lit(1)).alias("df")).crossJoin(F.broadcast(index.corpus))  # one row
    joined = per_row.join(spread, "query_id").join(index.lengths, "row_id")
    return joined.select("query_id", "row_id", _score(_idf(F.col("n"), F.col("df")), F.col("f")).alias("raw_score"))


def top_rows(found: DataFrame, limit: int, digits: int = 9) -> DataFrame:
    """The best rows of each query: front matter last, then score, then row_id. Scores are rounded before they are
    compared, so that sums made in another order rank alike."""
    front = F.col("front_matter") if "front_matter" in found.columns else F.lit(False)
    order = Window.partitionBy("query_id").orderBy(F.coalesce(front, F.lit(False)), F.round("raw_score", digits), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def search(index: Index, terms: DataFrame, limit: int = 8, weights: dict[str, float] = WEIGHTS, chunks: DataFrame | None = None) -> DataFrame:
    """A batch of queries of any mode. With ``chunks`` (row_id, document_id, title, ordinal, front_matter), front
    matter ranks last and a document whose title is the query comes first."""
    found = match_terms(index, terms, weights)
    if "positions" in index.postings.columns:
        found = found.unionByName(match_phrases(index, terms, weights))
    elif terms.where(F.col("mode") == "phrase").limit(1).count():
        raise ValueError("the index holds no positions, which phrases need")
    if chunks is None:
        return top_rows(found, limit).withColumn("reason", F.lit("bm25"))
    known = chunks.select("row_id", "document_id", "title", "ordinal", "front_matter")
    ranked = top_rows(found.join(known, "row_id"), limit + 1).select("query_id", "row_id", "document_id", "raw_score", "rank")
    first = promoted_titles(found, terms, known)
    both = first.select("query_id", "row_id", "document_id", "raw_score", F.lit(0).alias("rank"), F.lit("exact_title").alias("reason")).unionByName(
        ranked.join(first.select("query_id", "document_id"), ["query_id", "document_id"], "left_anti").withColumn("reason", F.lit("bm25"))
    )
    order = Window.partitionBy("query_id").orderBy("rank")
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def promoted_titles(found: DataFrame, terms: DataFrame, chunks: DataFrame) -> DataFrame:
    """For each AND or OR query the first chunk of a document whose title, letters' case aside, is the planned query."""
    asked = terms.where(F.col("mode").isin("and", "or")).groupBy("query_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))), lambda t: t["term"]), " ").alias("asked"))
    same = chunks.withColumn("asked", F.lower("title")).join(asked, "asked")
    order = Window.partitionBy("query_id").orderBy("ordinal", "row_id")
    one = same.withColumn("k", F.row_number().over(order)).where("k = 1").drop("k", "asked")
    return one.join(found, ["query_id", "row_id"], "left")
