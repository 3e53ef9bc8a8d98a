"""Query features, routing and evidence features as columns, and the same for one query on the driver."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r"[A-Za-z0-9]+(?:[._:/+#-][A-Za-z0-9]+)*"
# Words that a query may lose, and words that begin a question.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "can", "did", "do", "does", "for", "from", "how", "in", "into",
    "is", "it", "its", "of", "on", "or", "that", "the", "their", "this", "to", "using", "was", "were", "what", "when",
    "where", "which", "who", "why", "with",
)
QUESTION_WORDS = (
    "are", "can", "could", "did", "do", "does", "how", "is", "should", "what", "when", "where", "which", "who", "why",
    "would",
)
IDENTIFIER = (
    r"(?:\b[A-Z][A-Z0-9_]{2,}\b|\b[A-Za-z][A-Za-z0-9]*_[A-Za-z0-9_]+\b|\b\w+::\w+\b|--[a-z0-9][\w-]*"
    r"|(?i:\bRFC\s*)?\d{2,5}\b|\b\w+\.\w+\b|(?i:\bC\+\+|\bC#|\.NET\b))"
)
REGISTRY_CORPUS = "iana-protocol-registries"


def query_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def meaningful_tokens(text: Column) -> Column:
    """Without stop words, unless nothing would be left; repeats stay."""
    stop = F.array(*map(F.lit, STOP_WORDS))
    every = query_tokens(text)
    kept = F.filter(every, lambda t: ~F.array_contains(stop, t))
    return F.when(F.size(kept) > 0, kept).otherwise(every)


def identifiers(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + IDENTIFIER), F.lit(0))


def route(query: Column, corpus: Column, has_hybrid: Column, mode: Column) -> tuple[Column, Column]:
    """(retrieval, reason): rules in order, the first that fits decides."""
    every, found = query_tokens(query), identifiers(query)
    distinct = F.size(F.array_distinct(F.transform(found, F.lower)))
    question = F.array(*map(F.lit, QUESTION_WORDS))
    terse = (F.size(every) > 0) & ~F.array_contains(question, F.get(every, 0)) & (F.size(every) <= 7) & (F.size(meaningful_tokens(query)) <= 5)
    rules = [
        (~has_hybrid, "no semantic index is published for the corpus"),
        (corpus == REGISTRY_CORPUS, "registry rows are exact identifiers"),
        (mode.isin("phrase", "exact") | query.contains('"'), "an exact or phrase match is asked for"),
        ((F.size(found) > 0) & (F.size(every) <= 8) & (distinct / F.greatest(F.lit(1), F.size(every)) >= 0.4), "technical identifiers dominate"),
        (terse, "a terse technical phrase"),
    ]
    retrieval, reason = F.when(rules[0][0], "bm25"), F.when(rules[0][0], rules[0][1])
    for rule, why in rules[1:]:
        retrieval, reason = retrieval.when(rule, "bm25"), reason.when(rule, why)
    return retrieval.otherwise("hybrid"), reason.otherwise("concepts in natural language gain from both indexes")


def coverage(query: Column, text: Column) -> Column:
    """The share of the query's distinct tokens that the text has."""
    wanted = F.array_distinct(query)
    return F.when(F.size(wanted) == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(wanted, query_tokens(text))) / F.size(wanted))


# What each feature may add to the first-stage score.
TITLE_GAIN, HEADING_GAIN, TEXT_GAIN, DUAL_GAIN, LEXICAL_CAP = 0.008, 0.004, 0.0015, 0.002, 0.0015
IDENTIFIER_GAIN, EXACT_TITLE_GAIN = 0.035, 0.10


def evidence_score(query: Column, base: Column, title: Column, heading: Column, text: Column, dual: Column, exact_title: Column) -> Column:
    wanted = meaningful_tokens(query)
    lexical = TITLE_GAIN * coverage(wanted, title) + HEADING_GAIN * coverage(wanted, heading) + TEXT_GAIN * coverage(wanted, text)
    lexical = F.least(F.lit(LEXICAL_CAP), lexical + F.when(dual, DUAL_GAIN).otherwise(0.0))
    searched = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(heading, F.lit("")), F.coalesce(text, F.lit(""))))
    named = F.array_distinct(F.transform(identifiers(query), F.lower))
    met = F.size(F.filter(named, lambda name: searched.contains(name)))
    share = F.when(F.size(named) == 0, F.lit(0.0)).otherwise(met / F.size(named))
    return F.round(base + lexical + IDENTIFIER_GAIN * share + F.when(exact_title, EXACT_TITLE_GAIN).otherwise(0.0), 12)
