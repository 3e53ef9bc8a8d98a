"""Evaluation of any retriever against a suite of cases, and of a collection with all that it does to a ranking."""

from __future__ import annotations

import hashlib
import math
import time
from collections.abc import Callable, Mapping, Sequence
from statistics import fmean

from quarry.operators.evaluation import CUTOFFS, RANK_CUTOFF, RECALL_CUTOFFS, metrics_plain, validate_suite
from quarry.plans.publish import canonical
from quarry.session import Collection

#: (query, limit, mode) to rows with document_id, and, if they stand for several, ``alternates``.
Retriever = Callable[[str, int, str], Sequence[Mapping]]


def _nearest(values: Sequence[float], percent: float) -> float:
    return sorted(values)[max(0, math.ceil(percent * len(values) / 100) - 1)]


def groups(rows: Sequence[Mapping]) -> list[list[str]]:
    """Each document once, at its first place, with the ids that stand for it."""
    once = {}
    for row in rows:
        once.setdefault(str(row["document_id"]), [str(a) for a in row.get("alternates") or [] if a])
    return [[name, *others] for name, others in once.items()]


def summary(cases: Sequence[Mapping]) -> dict:
    """Means of the metrics and exact percentiles of the latencies."""
    if not cases:
        return {"cases": 0}
    names = sorted({n for c in cases for n in c["metrics"]})
    out = {"cases": len(cases)} | {n: round(fmean(c["metrics"][n] for c in cases if n in c["metrics"]), 6) for n in names}
    took = [c["latency_ms"] for c in cases]
    return out | {"mean_ms": round(fmean(took), 3), **{f"p{p}_ms": round(_nearest(took, p), 3) for p in (50, 95, 99)}, "max_ms": round(max(took), 3)}


def evaluate(suite: Mapping, retriever: Retriever, identity: Mapping | None = None) -> dict:
    """A report: each case's metrics, their means over all and by type of query, and the hash of the suite."""
    wrong = validate_suite(suite)
    if wrong:
        raise ValueError("; ".join(wrong))
    cases = []
    for k, case in enumerate(suite["cases"]):
        relevance = case.get("relevance") or {t: 1 for t in case["expected_titles"]}
        began = time.perf_counter()
        rows = [r if isinstance(r, Mapping) else r.asDict() for r in retriever(case["query"], suite.get("candidate_chunks", 50), case.get("query_mode", "and"))]
        took = (time.perf_counter() - began) * 1000
        by_title = "relevance" not in case or case.get("relevance_kind") == "title"
        ranked = [[r["title"]] for r in rows] if by_title else groups(rows)
        metrics = metrics_plain(ranked, relevance, tuple(suite.get("success_cutoffs", CUTOFFS)), tuple(suite.get("recall_cutoffs", RECALL_CUTOFFS)), suite.get("rank_cutoff", RANK_CUTOFF))
        if by_title:  # grades of titles say nothing about gain
            metrics = {n: v for n, v in metrics.items() if not n.startswith("ndcg")}
        cases.append({"id": case.get("id", str(k)), "query": case["query"], "query_type": case.get("query_type", "all"), "metrics": {n: round(v, 6) for n, v in metrics.items()}, "latency_ms": round(took, 3), "top": ranked[:10]})
    kinds = sorted({c["query_type"] for c in cases})
    sha = hashlib.sha256(canonical(suite).encode()).hexdigest()
    return {"suite": suite.get("name"), "suite_sha256": sha, "overall": summary(cases), "by_query_type": {k: summary([c for c in cases if c["query_type"] == k]) for k in kinds}, "cases": cases, **(identity or {})}


def evaluate_collection(suite: Mapping, held: Collection, retrieval: str = "auto", names: Sequence[str] | None = None, rerank: bool = True) -> dict:
    """The path that a user's search takes: routing, fusion, reranking, near copies set aside."""

    def ask(query: str, limit: int, mode: str) -> list:
        return held.search(query, min(limit, 50), mode, retrieval, names, rerank).collect()

    return evaluate(suite, ask, {"retriever": f"collection-{retrieval}" + ("-reranked" if rerank else ""), "corpora": sorted(held.corpora)})
