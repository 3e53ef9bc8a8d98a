"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a Boolean column over facts of the text that is true where the rule rejects. The cascade first runs each
rule on a sample of all rows, long ones included, takes the median of its seconds and the share that it rejects, and
orders the rules by rejection per cost; a CASE expression then stops at the first rule that rejects, so that the dear
rules see few rows. The order changes the cost and the name of the first rule that rejects, never the verdict. The
words of a text are split once for all rules; :func:`report` must count everything in every row, and its rules then
read these counts.

Cases: a null text counts as empty (no words, rejected by ``few_words``); an empty table gives an empty result;
repeated rows are judged one by one; texts are read whole whatever their length; other columns are left alone, also
if they bear the names of inner columns; the columns that :func:`judge` and :func:`measure` add by name replace those
of the same name, and :func:`keep` adds none.
"""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.runtime import quoted, remove, stored_at, unused

#: White space that parts words: space and U+0009 to U+000D.
SPACE = "[ \\t-\\r]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
SAMPLE_ROWS = 1000  # on average
TIMES = 3


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once: lambda variables keep Catalyst from copying it into loops."""
    return F.transform(F.array(value), body).getItem(0)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACE + "+", "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^ \\t-\\r]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_repeat_words(tokens: Column) -> Column:
    """Words that lie in a window of five words which the text holds twice or more.

    Windows are compared by a 64-bit hash of their words: with n windows in a text the chance of a false match is
    about n * n / 2**65. Texts without a repeated window, most of them, end after one distinct count.
    """

    def covered(starts: Column) -> Column:
        step = F.transform(
            starts,
            lambda at, k: F.when(k + 1 < F.size(starts), F.least(F.lit(WINDOW), F.get(starts, k + 1) - at)).otherwise(F.lit(WINDOW)),
        )
        return F.aggregate(step, F.lit(0), lambda total, x: total + x).cast("long")

    def repeated(pairs: Column) -> Column:
        same = lambda k, x: F.coalesce(F.get(pairs, k)["h"] == x["h"], F.lit(False))
        found = F.filter(pairs, lambda x, k: same(k - 1, x) | same(k + 1, x))
        return let(F.array_sort(F.transform(found, lambda x: x["at"])), covered)

    def count(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(pairs, repeated))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    return F.when(F.size(tokens) < WINDOW + 1, F.lit(0).cast("long")).otherwise(let(windows(tokens), count))


class Facts:
    """Columns that rules read: of a text, or of columns that hold them already."""

    def __init__(self, text: Column, **known: Column):
        self.text = text
        self.words = known.get("words", words(text))
        self.n_words = known.get("n_words", F.size(self.words).cast("long"))
        self.word_chars = known.get("word_chars", word_chars(text))
        self.n_symbols = known.get("n_symbols", n_symbols(text))
        self.n_repeat_words = known.get("n_repeat_words", let(self.words, n_repeat_words))
        self.lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^ \\t-\\r]"))


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the facts of a text, nulls already replaced, to a Boolean column."""

    name: str
    rejects: Callable[[Facts], Column]


def few_words(least: int = 10) -> Rule:
    return Rule("few_words", lambda f: f.n_words < least)


def repeated_words(percent: int = 20) -> Rule:
    return Rule("repeated_words", lambda f: f.n_repeat_words * 100 > f.n_words * percent)


def symbol_share(percent: int = 5) -> Rule:
    return Rule("symbol_share", lambda f: f.n_symbols * 100 > f.word_chars * percent)


def duplicate_lines(percent: int = 50) -> Rule:
    """The share of lines, of those with a word, that equal an earlier one; texts of a few lines are let pass."""
    return Rule("duplicate_lines", lambda f: let(f.lines, lambda x: (F.size(x) >= 4) & ((F.size(x) - F.size(F.array_distinct(x))) * 100 > F.size(x) * percent)))


def word_length(least: int = 2, most: int = 25) -> Rule:
    """The mean word length lies outside the bounds."""
    return Rule("word_length", lambda f: (f.word_chars < f.n_words * least) | (f.word_chars > f.n_words * most))


def shouting(percent: int = 60) -> Rule:
    """More than this share of a text's letters are capitals, in texts of 40 letters or more."""

    def rejects(f: Facts) -> Column:
        letters = F.length(F.regexp_replace(f.text, "[^\\p{L}]+", ""))
        capitals = F.length(F.regexp_replace(f.text, "[^\\p{Lu}]+", ""))
        enough = let(letters, lambda n: (n >= 40) & (capitals * 100 > n * percent))
        return (capitals * 100 > 40 * percent) & enough  # letters are counted only where there are capitals enough

    return Rule("shouting", rejects)


def default_rules() -> list[Rule]:
    return [few_words(), repeated_words(), symbol_share(), duplicate_lines(), word_length(), shouting()]


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def estimate(docs: DataFrame, rules: list[Rule], facts: Callable[[DataFrame], tuple[DataFrame, Facts]], sample_rows: int = SAMPLE_ROWS, text: str = "text") -> list[Estimate]:
    """Cost and share of rejections of each rule on a random sample of about ``sample_rows`` rows of any length (for
    the plan only: it decides the order of the rules, and all rows are judged by all rules). The sample stays in the
    shared folder; each rule is timed ``TIMES`` times over it, as ``facts`` will present the texts to it."""
    n = docs.count()
    some = docs.select(F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    some = some.sample(min(1.0, sample_rows / n), seed=11) if n else some
    sample, path = stored_at(some.repartition(min(8, max(1, n))), "quality-sample")
    sample, given = facts(sample)

    def timed(column: Column) -> tuple[float, float]:
        took = []
        for _ in range(TIMES):
            began = time.perf_counter()
            rejected, rows = sample.agg(F.sum(column.cast("int")), F.count(F.lit(1))).first()
            took.append(time.perf_counter() - began)
        return statistics.median(took), (rejected or 0) / max(rows, 1)

    timed(F.length("text") > 0)
    scan, _ = timed(F.length("text") > 0)
    found = []
    for rule in rules:
        seconds, rejected = timed(rule.rejects(given))
        found.append(Estimate(rule.name, max(seconds - scan, 1e-4), rejected))
    remove(docs.sparkSession, path)
    return found


def order(rules: list[Rule], estimates: list[Estimate]) -> list[Rule]:
    """Most rejections for a second first; among rules that reject nothing, cheap ones first."""
    by = {e.name: e for e in estimates}
    return sorted(rules, key=lambda r: (-by[r.name].worth, by[r.name].seconds, r.name))


def cascade(rules: list[Rule], facts: Facts) -> Column:
    """The name of the first rule that rejects, or null."""
    column = None
    for rule in rules:
        column = F.when(rule.rejects(facts), rule.name) if column is None else column.when(rule.rejects(facts), rule.name)
    return F.lit(None).cast("string") if column is None else column.otherwise(F.lit(None).cast("string"))


def first_failure(rules: list[Rule], text: Column) -> Column:
    """:func:`cascade` over a text whose words are split once: in a lambda variable, which no rewriting of the plan
    copies into the rules."""
    return let(words(text), lambda w: let(F.size(w).cast("long"), lambda n: cascade(rules, Facts(text, words=w, n_words=n))))


def judge(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS, into: str = "failed_rule") -> DataFrame:
    """``docs`` with the column ``into``: the rule that rejects, or null where the text stays."""
    rules = rules or default_rules()
    ordered = order(rules, estimate(docs, rules, _split_sample, sample_rows, text))
    others = [F.col(quoted(n)) for n in docs.columns if n.lower() != into.lower()]
    return docs.select(*others, first_failure(ordered, F.coalesce(F.col(quoted(text)), F.lit(""))).alias(into))


def _split_sample(sample: DataFrame) -> tuple[DataFrame, Facts]:
    return stored_at(sample.withColumn("words", words(F.col("text"))), "quality-words")[0], Facts(F.col("text"), words=F.col("words"))


def keep(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with the same columns."""
    mark = unused("_failed", docs.columns)
    return judge(docs, rules, text, sample_rows, mark).where(F.col(mark).isNull()).drop(mark)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules rest on."""
    mark = unused("_counted", docs.columns)
    t = F.coalesce(F.col(quoted(text)), F.lit(""))
    counted = docs.withColumn(mark, let(words(t), lambda w: F.struct(F.size(w).cast("long").alias("n"), n_repeat_words(w).alias("r"))))
    return counted.withColumns(
        {"n_words": F.col(mark)["n"], "word_chars": word_chars(t), "n_symbols": n_symbols(t), "n_dup_lines": n_dup_lines(t), "n_repeat_words": F.col(mark)["r"]}
    ).drop(mark)


def _measured(docs: DataFrame, text: str = "text") -> tuple[DataFrame, Facts]:
    names = ("n_words", "word_chars", "n_symbols", "n_repeat_words")
    return measure(docs, text), Facts(F.coalesce(F.col(quoted(text)), F.lit("")), **{n: F.col(n) for n in names})


def report(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: the counts, whether the base rules fail, and the verdict of the whole cascade.

    The counts are wanted of every row, so no rule can save them: the base rules read them first, and the cascade of
    the other rules runs only for rows that these let pass.
    """
    others = [symbol_share(), duplicate_lines(), word_length(), shouting()]
    thin = docs.select("doc_id", "text")
    # the rules' own cost, on counts that are there already
    ordered = order(others, estimate(thin, others, _counted_sample, sample_rows))
    counted, facts = _measured(thin)
    base = (facts.n_words < 10) | (facts.n_repeat_words * 100 > facts.n_words * 20)
    verdict = F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(ordered, facts).isNull())
    return counted.withColumn("base_failed", base).withColumn("kept", verdict).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _counted_sample(sample: DataFrame) -> tuple[DataFrame, Facts]:
    counted, facts = _measured(sample)
    return stored_at(counted, "quality-counted")[0], facts
