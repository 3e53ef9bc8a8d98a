"""Retrieval quality: success, recall, reciprocal rank and gain at fixed cut-offs, and exact percentiles."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUTOFFS = (1, 5, 10)
RECALL_CUTOFFS = (5, 10, 50)
RANK_CUTOFF = 10


def metrics_plain(ranked: Sequence[Sequence[str]], relevance: Mapping[str, int], cutoffs=CUTOFFS, recalls=RECALL_CUTOFFS, rank_cutoff: int = RANK_CUTOFF) -> dict[str, float]:
    """For one query: each place of the ranking is a group of ids that stand for one another, and a relevant id
    counts where it first appears."""
    gains, hits, seen = [], [], set()
    for group in ranked:
        new = [i for i in dict.fromkeys(group) if i in relevance and i not in seen]
        seen.update(new)
        hits.append(len(new))
        gains.append(max((2 ** relevance[i] - 1 for i in new), default=0))
    out = {f"success@{k}": float(any(hits[:k])) for k in cutoffs}
    out |= {f"recall@{k}": sum(hits[:k]) / len(relevance) if relevance else 0.0 for k in recalls}
    first = next((i for i, h in enumerate(hits[:rank_cutoff], 1) if h), None)
    out[f"mrr@{rank_cutoff}"] = 1 / first if first else 0.0
    ideal = sorted((2**g - 1 for g in relevance.values()), reverse=True)[:rank_cutoff]
    dcg = lambda values: sum(v / math.log2(i + 1) for i, v in enumerate(values, 1))
    out[f"ndcg@{rank_cutoff}"] = dcg(gains[:rank_cutoff]) / dcg(ideal) if ideal else 0.0
    return out


def case_metrics(ranked: DataFrame, relevance: DataFrame, cutoffs=CUTOFFS, recalls=RECALL_CUTOFFS, rank_cutoff: int = RANK_CUTOFF) -> DataFrame:
    """For a batch: ``ranked`` (query_id, document_id, rank), ``relevance`` (query_id, document_id, grade >= 1). One row
    for each query that has a relevant document."""
    first = ranked.groupBy("query_id", "document_id").agg(F.min("rank").alias("rank"))
    judged = relevance.join(first, ["query_id", "document_id"], "left")
    gain, rank = F.pow(F.lit(2.0), F.col("grade")) - 1, F.col("rank")
    best = F.sort_array(F.collect_list(gain), asc=False)  # one number a judged document
    ideal = F.aggregate(F.transform(F.slice(best, 1, rank_cutoff), lambda v, i: v / F.log2(i + F.lit(2.0))), F.lit(0.0), lambda total, v: total + v)
    dcg = F.sum(F.when(rank <= rank_cutoff, gain / F.log2(rank + F.lit(1.0))).otherwise(0.0))
    columns = [F.coalesce(F.max((rank <= k).cast("double")), F.lit(0.0)).alias(f"success_{k}") for k in cutoffs]
    columns += [(F.sum(F.coalesce((rank <= k).cast("double"), F.lit(0.0))) / F.count(F.lit(1))).alias(f"recall_{k}") for k in recalls]
    columns += [F.coalesce(F.max(F.when(rank <= rank_cutoff, 1 / rank)), F.lit(0.0)).alias(f"mrr_{rank_cutoff}"), (dcg / ideal).alias(f"ndcg_{rank_cutoff}")]
    return judged.groupBy("query_id").agg(*columns)


def mean_metrics(cases: DataFrame, by: str | None = None, digits: int = 6) -> DataFrame:
    """Means over all cases, or for each value of a column."""
    names = [c for c in cases.columns if c not in ("query_id", by)]
    means = [F.round(F.avg(c), digits).alias(c) for c in names]
    return (cases.groupBy(by) if by else cases.groupBy()).agg(F.count(F.lit(1)).alias("cases"), *means)


def nearest_rank(values: DataFrame, column: str, percents: Sequence[float], by: str | None = None) -> DataFrame:
    """The value at place ceil(p / 100 * n) of the sorted values, by counting equal values first: no group is sorted
    in one task beyond its distinct values."""
    from pyspark.sql import Window

    keys = [by] if by else []
    counted = values.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    total = counted.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    window = Window.partitionBy(*[F.col(k) for k in keys] or [F.lit(1)]).orderBy(column)
    ranked = counted.withColumn("_upto", F.sum("_n").over(window))
    ranked = ranked.join(total, keys) if keys else ranked.crossJoin(F.broadcast(total))  # one row
    picks: list[Column] = [F.min(F.when(F.col("_upto") >= F.ceil(F.lit(p / 100.0) * F.col("_total")), F.col(column))).alias(f"p{p:g}") for p in percents]
    return ranked.groupBy(*keys).agg(*picks)


def validate_suite(suite: Mapping) -> list[str]:
    """What is wrong with a suite of test cases, as messages; nothing if it is fine."""
    found = []
    version = suite.get("schema_version", 1)
    cases = suite.get("cases")
    if not isinstance(cases, list) or not cases:
        return ["cases must be a list that is not empty"]
    seen = set()
    for i, case in enumerate(cases):
        if not isinstance(case.get("query"), str) or not case["query"].strip():
            found.append(f"case {i}: query")
        if version == 1:
            titles = case.get("expected_titles")
            if not isinstance(titles, list) or not titles:
                found.append(f"case {i}: expected_titles")
            continue
        if not isinstance(case.get("id"), str) or case["id"] in seen:
            found.append(f"case {i}: id")
        seen.add(case.get("id"))
        relevance = case.get("relevance")
        if not isinstance(relevance, dict) or not relevance or any(isinstance(g, bool) or not isinstance(g, int) or g < 1 for g in relevance.values()):
            found.append(f"case {i}: relevance")
    return found
