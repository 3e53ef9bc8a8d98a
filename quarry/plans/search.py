"""Document search with relaxed variants, for a batch of queries at once.

Where a query of four or more AND terms has no exact title among its hits, variants of it are searched: windows of
four and then three terms of queries longer than six, the first that has a hit of each width; else queries with one
of the first six terms left out; and, if nothing else helped, windows again. All variants of all queries are matched
in one job, from which the rules then pick.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import lexical
from quarry.operators.fusion import RRF_K
from quarry.runtime import stored

# How many starts are tried, and what a variant's hits weigh.
STARTS, WINDOW_4, WINDOW_3, LEFT_OUT = 6, 0.65, 0.55, 0.8
CANDIDATES = 160  # chunks of a variant


def variants(queries: DataFrame) -> DataFrame:
    """(query_id, terms) to (query_id, n, variant_id, kind, place, weight, terms)."""
    n = F.size("terms")

    def windows(width: int, kind: str, weight: float):
        starts = F.when(n > width, F.sequence(F.lit(0), F.least(n - width, F.lit(STARTS - 1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda s: F.struct(F.lit(kind).alias("kind"), s.alias("place"), F.lit(weight).alias("weight"), F.slice("terms", s + 1, width).alias("terms")))

    dropped = F.when(n >= 4, F.sequence(F.lit(0), F.least(n, F.lit(STARTS)) - 1)).otherwise(F.array().cast("array<int>"))
    less = F.transform(dropped, lambda d: F.struct(F.lit("drop").alias("kind"), d.alias("place"), F.lit(LEFT_OUT).alias("weight"), F.filter(F.col("terms"), lambda t, i: i != d).alias("terms")))
    whole = F.array(F.struct(F.lit("whole").alias("kind"), F.lit(0).alias("place"), F.lit(1.0).alias("weight"), F.col("terms").alias("terms")))
    windowed = F.when(n > 4, F.concat(windows(4, "w4", WINDOW_4), windows(3, "w3", WINDOW_3))).otherwise(F.slice(less, 1, 0))
    every = queries.select("query_id", n.alias("n"), F.explode(F.concat(whole, windowed, less)).alias("v")).select("query_id", "n", "v.*")
    order = Window.partitionBy("query_id", F.array_join("terms", " ")).orderBy(F.when(F.col("kind") == "whole", 0).when(F.col("kind") == "w4", 1).when(F.col("kind") == "w3", 2).otherwise(3), "place")
    once = every.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")  # of equal variants the first
    return once.withColumn("variant_id", F.concat_ws("|", F.col("query_id").cast("string"), "kind", F.col("place").cast("string")))


_PLACES = {"whole": 0, "w4": 1, "w3": 2, "drop": 3}  # the order in which variants are tried
PROCEDURE = "procedure_method"


def search_documents(index: lexical.Index, queries: DataFrame, chunks: DataFrame, limit: int = 8, candidates: int = CANDIDATES, relax: bool = True) -> DataFrame:
    """(query_id, document_id, row_id, fusion_score, matched_variants, relaxed, reason, position) for queries (query_id,
    terms). ``row_id`` is the chunk that stands for the document: the first that was found, but a chunk whose
    ``evidence_kind`` is a procedure, where the first is none, and the title's own best where the query holds the whole
    title. ``reason`` is ``bm25``, ``exact_title`` or ``relaxed_exact_title``."""
    every = variants(queries)
    every = stored(every if relax else every.where("kind = 'whole'"), "variants")
    terms = every.select(F.col("variant_id").alias("query_id"), F.lit("and").alias("mode"), F.posexplode("terms").alias("pos", "term"))
    hits = lexical.search(index, terms, candidates, chunks=chunks).select(F.col("query_id").alias("variant_id"), "row_id", "document_id", "rank", "reason")
    found = stored(hits.join(every.withColumn("variant", F.array_join("terms", " ")).drop("terms"), "variant_id"), "variant-hits")
    used = _used(found, relax)

    kind = chunks.select("row_id", "title", (F.col("evidence_kind") == PROCEDURE if "evidence_kind" in chunks.columns else F.lit(False)).alias("procedure"))
    ordered = used.join(kind, "row_id").withColumn("step", F.struct(F.create_map(*(F.lit(x) for p in _PLACES.items() for x in p))[F.col("kind")], "place", "rank"))
    own = Window.partitionBy("variant_id", "document_id").orderBy("rank")
    ordered = ordered.withColumn("nth", F.row_number().over(own))
    ranks = ordered.where("nth = 1").withColumn("document_rank", F.row_number().over(Window.partitionBy("variant_id").orderBy("rank")))
    scored = ranks.groupBy("query_id", "document_id").agg(
        F.sum(F.col("weight") / (RRF_K + F.col("document_rank"))).alias("fusion_score"), F.array_sort(F.collect_set("variant")).alias("matched_variants"), F.first("relaxed").alias("relaxed")
    )
    standing = ordered.groupBy("query_id", "document_id").agg(
        F.min_by(F.struct("row_id", "title", "procedure", "reason"), "step").alias("first"),
        F.min_by(F.struct("row_id", "title", "procedure", "reason"), F.when(F.col("procedure") & (F.col("nth") > 1), F.col("step"))).alias("other"),
    )
    chosen = F.when(~F.col("first.procedure") & F.col("other").isNotNull(), F.col("other")).otherwise(F.col("first"))
    named = scored.join(standing.select("query_id", "document_id", chosen.alias("c")), ["query_id", "document_id"]).select(*scored.columns, "c.row_id", "c.title", "c.reason")
    named = stored(named, "scored-documents")

    # titles that the query holds whole are searched; only the document that leads that search is promoted
    title_terms = F.array_distinct(lexical.plan_terms(F.col("title")))
    whole = named.join(queries.select("query_id", "terms"), "query_id").where((F.size(title_terms) >= 2) & (F.size(F.array_except(title_terms, F.col("terms"))) == 0))
    titles = whole.select("title").distinct()
    asked = titles.select(F.col("title").alias("query_id"), F.lit("and").alias("mode"), F.posexplode(lexical.plan_terms(F.col("title"))).alias("pos", "term"))
    best = lexical.search(index, asked, 1, chunks=chunks).select(F.col("query_id").alias("title"), "document_id", F.col("row_id").alias("lead_row"))
    promoted = whole.select("query_id", "document_id", "title").join(best, ["title", "document_id"]).drop("title")
    named = named.join(promoted, ["query_id", "document_id"], "left")
    lead = F.col("lead_row").isNotNull()
    scored = named.select(
        "query_id", "document_id", F.coalesce("lead_row", "row_id").alias("row_id"), (F.col("fusion_score") + F.when(lead, 1.0).otherwise(0.0)).alias("fusion_score"), "matched_variants", "relaxed",
        F.when(lead, F.when(F.col("relaxed"), "relaxed_exact_title").otherwise("exact_title")).otherwise(F.col("reason")).alias("reason"),
    )
    order = Window.partitionBy("query_id").orderBy(F.round("fusion_score", 12).desc(), "document_id")
    return scored.withColumn("position", F.row_number().over(order)).where(F.col("position") <= limit)


def _used(found: DataFrame, relax: bool) -> DataFrame:
    """The hits of the variants that the rules pick, with ``relaxed``."""
    state = found.groupBy("query_id").agg(
        F.max((F.col("kind") == "whole").cast("int")).alias("primary"),
        F.max(((F.col("kind") == "whole") & (F.col("reason") == "exact_title")).cast("int")).alias("titled"),
        F.min(F.when(F.col("kind") == "w4", F.col("place"))).alias("at4"),
        F.min(F.when(F.col("kind") == "w3", F.col("place"))).alias("at3"),
        F.first("n").alias("n"),
    )
    relaxed = F.lit(relax) & (F.col("n") >= 4) & (F.col("titled") == 0)
    may_window = (F.col("n") > 6) | ((F.col("primary") == 0) & (F.col("n") > 4))
    use4 = relaxed & may_window & F.col("at4").isNotNull()
    use3 = relaxed & may_window & F.col("at4").isNull() & F.col("at3").isNotNull()
    window_first = (F.col("n") > 6) & (F.col("at4").isNotNull() | F.col("at3").isNotNull())
    state = state.select("query_id", relaxed.alias("relaxed"), F.when(use4, F.col("at4")).alias("use4"), F.when(use3, F.col("at3")).alias("use3"), (relaxed & ~window_first).alias("use_drop"))
    return found.join(state, "query_id").where(
        (F.col("kind") == "whole") | ((F.col("kind") == "w4") & (F.col("place") == F.col("use4"))) | ((F.col("kind") == "w3") & (F.col("place") == F.col("use3"))) | ((F.col("kind") == "drop") & F.col("use_drop"))
    )
