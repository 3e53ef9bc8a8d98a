"""Secret scans: fixed patterns, and a battery of randomness tests under false-discovery control.

Base kinds, leftmost and non-overlapping each: ``assign`` (a key word, a sign, a value of six characters or more),
``access`` (an access key id) and ``hex`` (24 hexadecimal digits or more). Every other run of 20 or more characters
of the base64 and URL alphabets is a candidate ``random``. Its encoding is inferred from its characters, which maps
them to numbers below the alphabet's size, and three tests are made:

* chi-squared: the symbol counts against a uniform alphabet, and, for ordinary writing, how likely so few repeated
  symbols are;
* runs: the changes between capitals, small letters, digits and signs, against uniform draws and against writing,
  where joined words (``camelCase``, ``kebab-case``, paths) change at their joints only;
* serial correlation of neighbouring numbers, against draws.

A candidate must pass all three as uniform draws, and Fisher's method combines how unlikely its symbol counts, its runs
and its serial correlation are in ordinary writing. All of these probabilities enter one table of counts by length
class and probability step (at most ``len(LENGTHS) * STEPS`` rows), in which the Benjamini-Hochberg rule finds a bound
for each length class.

Where a base span lies in a run, what is left of the run on either side is a candidate. A run that no alphabet holds,
or that fails as uniform draws, is parted at its slashes, and the parts of 20 characters or more are candidates: so a
key in a URL's path is found.

Cases: a null text counts as empty and has no spans; the same secret twice gives two spans; spans that start and end
alike are put out each, by kind; texts are read whole and in time that grows with their length; a null doc_id stays
null; an empty table gives an empty result; extra columns, whatever their names, are ignored by :func:`scan` and kept
by :func:`redact`.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.runtime import in_slices, numbered, ship, stored

KINDS = ("assign", "access", "hex", "random")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + "|" + _either_case("api") + "_?" + _either_case("key")
#: The last group is the value; a key is looked for first, as a search for the whole is slow.
ASSIGN = re.compile(rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
LEAST_VALUE = 6
LEAST_CANDIDATE = 20

#: Alphabets by which a candidate may be encoded, small ones first.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "hex-capitals": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base36-capitals": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64-url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_VALUES = {name: {c: i for i, c in enumerate(letters)} for name, letters in ALPHABETS.items()}

LENGTHS = (20, 24, 32, 40, 48, 64, 96, 128, 256)  # lower ends of the length classes
STEPS = 400
STEP = 0.1  # of the natural logarithm
UNIFORM_LEVEL = 1e-3
FALSE_DISCOVERIES = 0.01
#: Ordinary writing: how often two letters agree, and how often the character class changes at most.
TEXT_REPEAT, TEXT_CHANGE = 0.065, 0.15
#: Mean and spread of the serial correlation of joined words under the alphabets above.
TEXT_SERIAL, TEXT_SERIAL_SPREAD = 0.15, 0.25


def _below(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _kind_of(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def infer(token: str) -> str | None:
    """The smallest alphabet that holds the token, or none. Letters alone in one case are a word, not an encoding."""
    used = set(token)
    if not any(c.isdigit() for c in used) and len({_kind_of(c) for c in used if c.isalpha()}) < 2:
        return None
    return next((name for name, values in _VALUES.items() if used <= values.keys()), None)


def battery(token: str) -> float | None:
    """How unlikely the token is as ordinary writing, as a natural logarithm; none if it fails as uniform draws."""
    body = token.rstrip("=")
    encoding, n = infer(body), len(body)
    if encoding is None:
        return None
    values = _VALUES[encoding]
    size, symbols = len(values), [values[c] for c in body]
    # chi-squared of the symbol counts; Wilson and Hilferty's cube root makes it normal
    squares = sum(c * c for c in Counter(body).values())
    chi = squares * size / n - n
    z = ((max(chi, 1e-9) / (size - 1)) ** (1 / 3) - (1 - 2 / (9 * (size - 1)))) / math.sqrt(2 / (9 * (size - 1)))
    uniform = [1 - _below(z)]
    pairs = n * (n - 1) / 2
    repeats = (squares - n) / 2
    writing = [_below((repeats + 0.5 - pairs * TEXT_REPEAT) / math.sqrt(pairs * TEXT_REPEAT + n**3 * TEXT_REPEAT**2 / 8))]
    # runs of character classes
    share = Counter(_kind_of(c) for c in values)
    stay = sum((x / size) ** 2 for x in share.values())
    changes = sum(_kind_of(a) != _kind_of(b) for a, b in zip(body, body[1:], strict=False))
    expected = (n - 1) * (1 - stay)
    uniform.append(2 * _below(-abs(changes - expected) / math.sqrt(max((n - 1) * stay * (1 - stay), 1e-9)) / 1.2))
    # a capital before a small letter begins a word, and a sign joins two
    changes = sum((x, y) != (1, 0) and x != y and 3 not in (x, y) for x, y in ((_kind_of(a), _kind_of(b)) for a, b in zip(body, body[1:], strict=False)))
    writing.append(sum(math.comb(n - 1, k) * TEXT_CHANGE**k * (1 - TEXT_CHANGE) ** (n - 1 - k) for k in range(changes, n)) if n < 500 else _below(-(changes - 0.5 - (n - 1) * TEXT_CHANGE) / math.sqrt((n - 1) * TEXT_CHANGE * (1 - TEXT_CHANGE))))
    # serial correlation at lag one
    mean = sum(symbols) / n
    around = sum((x - mean) ** 2 for x in symbols)
    r = sum((a - mean) * (b - mean) for a, b in zip(symbols, symbols[1:], strict=False)) / around if around else 1.0
    uniform.append(2 * _below(-abs(r + 1 / n) * math.sqrt(n)))
    writing.append(_below((r - TEXT_SERIAL) / TEXT_SERIAL_SPREAD))
    if min(uniform) < UNIFORM_LEVEL:
        return None
    x = -sum(math.log(max(p, 1e-300)) for p in writing)  # Fisher: half of a chi-squared with six degrees
    return -x + math.log1p(x + x * x / 2)


def length_class(n: int) -> int:
    return max(i for i, least in enumerate(LENGTHS) if n >= least)


def _base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _runs(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of candidate characters, less the base spans."""
    covered: list[tuple[int, int]] = []  # the base spans, overlapping ones as one
    for start, _, end in base:
        if covered and start < covered[-1][1]:
            covered[-1] = covered[-1][0], max(end, covered[-1][1])
        else:
            covered.append((start, end))
    ends = [e for _, e in covered]
    for m in CANDIDATE.finditer(text):
        at, k = m.start(), bisect.bisect_right(ends, m.start())
        while k < len(covered) and covered[k][0] < m.end():
            yield at, min(covered[k][0], m.end())
            at, k = covered[k][1], k + 1
        yield at, m.end()


def _candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, length class, step) of each candidate; step -1: it fails as uniform."""
    found = []

    def test(start: int, end: int) -> bool:
        token = text[start:end]
        body = len(token.rstrip("="))
        if body < LEAST_CANDIDATE:
            return False
        p = battery(token)
        if p is None and "/" in token:
            at, parts = start, token.split("/")
            longs = []
            for part in parts:
                if len(part.rstrip("=")) >= LEAST_CANDIDATE:
                    longs.append((at, at + len(part)))
                at += len(part) + 1
            if longs:  # the parts stand for the whole
                for span in longs:
                    test(*span)
                return True
        found.append((start, end, length_class(body), -1 if p is None else min(STEPS - 1, int(-p / STEP))))
        return True

    for start, end in _runs(text, base):
        test(start, end)
    return found


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.IntegerType())])
_CANDIDATE = T.StructType([T.StructField(n, T.IntegerType()) for n in ("start", "end", "length_class", "step")])
_FOUND = [T.StructField("base", T.ArrayType(_SPAN)), T.StructField("candidates", T.ArrayType(_CANDIDATE))]
_ARROW_SPAN = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "kind", "end")]))
_ARROW_CANDIDATE = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "end", "length_class", "step")]))


def _found(columns: list[str]):
    """The columns with two more: base spans and candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            base, candidates = [], []
            for text in batch.column("text").to_pylist():
                b = _base(text or "")
                base.append([dict(zip(("start", "kind", "end"), s, strict=True)) for s in b])
                candidates.append([dict(zip(("start", "end", "length_class", "step"), c, strict=True)) for c in _candidates(text or "", b)])
            yield pa.RecordBatch.from_arrays([*map(batch.column, columns), pa.array(base, _ARROW_SPAN), pa.array(candidates, _ARROW_CANDIDATE)], names=[*columns, "base", "candidates"])

    return run


def bounds(counts: dict[tuple[int, int], int], level: float = FALSE_DISCOVERIES) -> dict[int, int]:
    """For each length class the least step that is a discovery, by Benjamini and Hochberg. A step stands for the
    largest probability in it; step -1 counts as a test made."""
    least = {}
    for of in {c for c, _ in counts}:
        steps = Counter({s: n for (c, s), n in counts.items() if c == of})
        made, seen = sum(steps.values()), 0
        for step in sorted((s for s in steps if s >= 0), reverse=True):
            seen += steps[step]
            if math.exp(-step * STEP) <= level * seen / made:
                least[of] = step
    return least


def _bounds_of(found: DataFrame) -> dict[int, int]:
    rows = found.select(F.explode("candidates").alias("c")).groupBy("c.length_class", "c.step").count().collect()  # at most len(LENGTHS) * (STEPS + 1)
    return bounds({(r["length_class"], r["step"]): r["count"] for r in rows})


def _scanned(docs: DataFrame, columns: list[str]) -> tuple[DataFrame, Column]:
    """``columns`` of ``docs`` with base spans and candidates, stored, and the column of all spans, in order."""
    ship(docs.sparkSession)
    schema = T.StructType([*(docs.schema[n] for n in columns), *_FOUND])
    found = stored(docs.mapInArrow(_found(columns), schema), "secrets")
    least = _bounds_of(found)

    def discovery(c: Column) -> Column:
        good = F.lit(False)
        for of, step in sorted(least.items()):
            good = good | ((c["length_class"] == of) & (c["step"] >= step))
        return good

    more = F.transform(F.filter("candidates", discovery), lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    return found, F.array_sort(F.concat("base", more))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``: an array of (start, kind, end), kind being a place in :data:`KINDS`, in order."""
    found, spans = _scanned(docs.select("doc_id", "text"), ["doc_id"])
    return found.select("doc_id", spans.alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    spans = F.col("spans")
    number = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return scan(docs).select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(joined(F.filter(spans, lambda s: s["kind"] < 3)).cast("binary"), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Every (start, kind, end) replaced by the kind's name in brackets, overlapping ones as one."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _masked(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts, spans = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
            new = [mask(t, [(x["start"], x["kind"], x["end"]) for x in s]) if s else t for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if n == "text" else batch.column(n) for n in columns], names=columns)

    return run


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span, overlapping ones as one, replaced by ``[kind]`` of its first; ``n_chars`` follows.

    Texts are scanned once; they wait in the shared folder with their candidates until the bounds are known."""
    inner = numbered(docs, ("text", "n_chars"))
    found, spans = _scanned(inner, inner.columns)
    touched = found.select(*inner.columns, spans.alias("spans"))
    out = touched.mapInArrow(_masked(inner.columns), inner.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.toDF(*docs.columns)
