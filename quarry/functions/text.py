"""Text functions: Unicode forms, search tokens, technical names and content identities.

Spark has no Unicode normalisation, no full case folding and no table of HTML entities. Python has; but a CASE does
not keep rows from a Python function, which gets every row of its stage. So what a function need not see is given to
it as null, and what it returns is put over the original: plain rows cross as empty cells.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.runtime import ship

_ASCII = r"^[\x00-\x7F]*$"


def _accents() -> tuple[str, str]:
    """Small letters with a mark and the letters that they fold to, by Unicode's own decomposition."""
    marked, plain = [], []
    for point in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        letter = chr(point)
        base = "".join(c for c in unicodedata.normalize("NFD", letter) if not unicodedata.combining(c))
        if base != letter and len(base) == 1:
            marked.append(letter)
            plain.append(base)
    return "".join(marked), "".join(plain)


_MARKED, _PLAIN = _accents()


def fold(text: Column) -> Column:
    """Small letters without marks; ``ß`` and other letters that do not decompose stay."""
    small = F.lower(text)
    return F.when(text.rlike(_ASCII), small).otherwise(F.translate(F.regexp_replace(small, r"\p{Mn}+", ""), _MARKED, _PLAIN))


def tokens(text: Column) -> Column:
    """Search tokens: runs of letters, numbers and private-use characters, folded."""
    return F.regexp_extract_all(fold(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}\p{Co}]+"), F.lit(0))


def tokens_plain(text: str) -> list[str]:
    """The same for a string on the driver."""
    import regex

    kept = regex.sub(r"\p{Mn}+", "", text.lower()).translate(str.maketrans(_MARKED, _PLAIN))
    return regex.findall(r"[\p{L}\p{N}\p{Co}]+", kept)


def _on_rows(function):
    """A function of one string as a pandas function over those rows that are not null."""

    def run(values: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(values), index=values.index, dtype=object)
        there = values.notna()
        out[there] = [function(v) for v in values[there]]
        return out

    run.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, T.StringType())


def _where(needed: Column, udf, text: Column, other: Column) -> Column:
    """``udf`` of the rows that need it; ``other`` for the rest."""
    return F.coalesce(udf(F.when(F.coalesce(needed, F.lit(False)), text)), other)


#: Every character below U+0300 is in NFC by itself and joins none.
_MAY_CHANGE = "[\\x{300}-\\x{10FFFF}]"


def _composed(text: str) -> str:
    return text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)


def nfc(text: Column) -> Column:
    return _where(text.rlike(_MAY_CHANGE), _on_rows(_composed), text, text)


def casefold(text: Column) -> Column:
    return _where(~text.rlike(_ASCII), _on_rows(str.casefold), text, F.lower(text))


def unescape(text: Column) -> Column:
    """HTML entities as characters."""
    return _where(text.contains("&"), _on_rows(html.unescape), text, text)


_TRIM = "^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$"


def normalize_content(text: Column) -> Column:
    """NFC, line ends as LF, no blanks at the ends of lines, no white space around the whole."""
    unified = F.regexp_replace(F.regexp_replace(nfc(text), "\r\n?", "\n"), "[ \t]+\n", "\n")
    return F.regexp_replace(unified, "(?U)" + _TRIM, "")


def content_id(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(normalize_content(F.coalesce(text, F.lit(""))).cast("binary"), 256))


def normalize_content_plain(text: str) -> str:
    unified = unicodedata.normalize("NFC", text).replace("\r\n", "\n").replace("\r", "\n")
    return re.sub(r"[ \t]+\n", "\n", unified).strip()


def collapse(text: Column) -> Column:
    """White space as single blanks, none around."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


# Names that a tokenizer would take apart, and what stands for them.
CPP, CSHARP, DOTNET = r"(?<![\w+])c\+\+(?!\+)", r"(?<![\w#])c#(?!#)", r"(?<!\w)\.net(?!\w)"
SCOPED = r"\b[A-Za-z_]\w*(?:::[A-Za-z_]\w*)+\b"
UNDERSCORED = r"\b[A-Za-z]\w*(?:_\w+)+\b"
_HINT = r"(?i)c\+\+|c#|\.net|\w::\w|[a-z]\w*_\w"
_SHORT = {"cpp": CPP, "csharp": CSHARP, "dotnet": DOTNET}
_SHORT_NAMES = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern in _SHORT.items()), re.I)
_LONG_NAMES = re.compile(f"(?P<scope>{SCOPED})|(?P<ident>{UNDERSCORED})")


def alias(prefix: str, name: str) -> str:
    return prefix + hashlib.sha256(name.casefold().encode()).hexdigest()[:20]


def technical_plain(text: str) -> str:
    """The words of the text with technical names replaced, or nothing if it has no such name."""
    text, short = _SHORT_NAMES.subn(lambda m: f" {m.lastgroup} ", text)
    text, long = _LONG_NAMES.subn(lambda m: f" {alias(m.lastgroup, m[0])} ", text)
    return " ".join(re.findall(r"[^\W_]+", text)).casefold() if short or long else ""


def technical_normalized(text: Column) -> Column:
    """Only texts that may have a technical name are looked at in Python."""
    return _where(text.rlike(_HINT), _on_rows(technical_plain), text, F.lit(""))


def register(spark: SparkSession) -> None:
    """``technical_normalized(text)`` for SQL; texts without a technical name give an empty string, nulls give null."""
    ship(spark)
    spark.udf.register("technical_normalized", _on_rows(technical_plain))
