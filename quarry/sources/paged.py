"""Paged documents whose text is there already: headings from the outline, page labels, methods of a procedure as
evidence of their own, and the gate that refuses scans without text.

Rows are pages: relative, page (from 1), label, text, has_images, outline (an array, null where a page opens nothing).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.corpus import forward_fill
from quarry.sources.markup import Block

LEAST_SEARCHABLE = 0.5
ROMAN = r"(?i)^[ivxlcdm]+$"
# How the methods of a recipe, and what holds for all of them, begin.
METHOD = re.compile(r"(?i)(?:\d+\.\s*)?with\s+.+")
SHARED = re.compile(r"(?i)(?:if possible,\s*add|to either drink\b|important\s*:\s*adapt|give (?:a|the) .*\bsips\b|warning\s*:)")
TWO_WAYS = re.compile(r"(?i)\b(?:2|two)\s+ways\b")
DRINK, SUGAR_DRINK, INSTEAD, SHARED_TITLE = "Rehydration drink", "Salt and sugar drink", "or, instead of sugar", "Shared procedure instructions"
LEAST_METHOD = 80
#: Of a title's word, what its text must have and must not have: a page of two columns that ran together has both.
INGREDIENTS = {"sugar": (["sugar"], ["boil", "powdered cereal"]), "cereal": (["cereal", "boil"], ["sugar"])}


def is_method(title: str, lines: list[str]) -> bool:
    """Long enough, with salt and a measure, and the ingredients of its own kind alone."""
    body = " ".join("\n".join(lines).casefold().split())
    if len("\n".join(lines)) < LEAST_METHOD or "salt" not in body or not re.search(r"\b(?:half|1/2|½|8)\b", body):
        return False
    kind = next((k for k in INGREDIENTS if k in title.casefold()), None)
    wanted, barred = INGREDIENTS.get(kind, ([], []))
    return all(w in body for w in wanted) and not any(b in body for b in barred)


def _spans(lines: list[str], text: str) -> list[tuple[str, list[str], bool]]:
    """(title, lines, whether it is a method) of the parts of a page that can be told apart."""
    found = []
    starts = [i for i, line in enumerate(lines) if METHOD.fullmatch(line)]
    if len(starts) > 1 and TWO_WAYS.search(text):
        shared = next((i for i in range(starts[-1] + 1, len(lines)) if SHARED.match(lines[i])), len(lines))
        parts = [lines[a:b] for a, b in zip(starts, [*starts[1:], shared], strict=True)]
        found = [(part[0], part, True) for part in parts if is_method(part[0], part)]
        if found and len("\n".join(lines[shared:])) >= LEAST_METHOD:
            found.append((SHARED_TITLE, lines[shared:], False))
    folded = [line.casefold() for line in lines]
    if SUGAR_DRINK.casefold() in folded:
        start = folded.index(SUGAR_DRINK.casefold())
        end = next((i for i in range(start + 1, len(lines)) if folded[i].startswith(INSTEAD)), None)
        if end is not None and is_method(SUGAR_DRINK, lines[start:end]):
            found.append((SUGAR_DRINK, lines[start:end], True))
    return found


def page_blocks(heading: list[str], text: str, attributes: dict[str, str], procedures: bool = False) -> list[Block]:
    """The page as it is, and with ``procedures`` the methods that it holds."""
    out = [Block(heading, text, "pdf-page", dict(attributes))]
    lines = [line.strip() for line in text.splitlines() if line.strip()]
    for title, own, method in _spans(lines, text) if procedures else []:
        kind = {"evidence_kind": "procedure_method", "procedure_method": title} if method else {"evidence_kind": "procedure_shared", "procedure_shared": "true"}
        out.append(Block([*heading, DRINK, title], "\n".join(own).strip(), "pdf-procedure-method", {**attributes, "derived_evidence": "true", **kind}))
    return out


def headed_pages(pages: DataFrame) -> DataFrame:
    """Pages with heading_path, the outline carried forward and ``Page <label>`` behind it, and front_matter, which
    roman labels tell."""
    carried = forward_fill(pages, "outline", "relative", "page")
    label = F.coalesce(F.when(F.length(F.trim("label")) > 0, F.trim("label")), F.col("page").cast("string"))
    path = F.concat(F.coalesce("outline", F.array().cast("array<string>")), F.array(F.concat(F.lit("Page "), label)))
    return carried.withColumns({"label": label, "heading_path": path, "front_matter": label.rlike(ROMAN)})


def searchable(pages: DataFrame) -> DataFrame:
    """relative, text_pages, image_pages, blank_pages, ratio: pages with text to those with text or images alone."""
    text = F.length(F.trim(F.coalesce("text", F.lit("")))) > 0
    image = ~text & F.coalesce("has_images", F.lit(False))
    number = lambda c: F.sum(c.cast("int")).cast("long")
    counted = pages.groupBy("relative").agg(number(text).alias("text_pages"), number(image).alias("image_pages"), number(~text & ~image).alias("blank_pages"))
    both = F.col("text_pages") + F.col("image_pages")
    return counted.withColumn("ratio", F.when(both > 0, F.col("text_pages") / both).otherwise(0.0))


def require_searchable(pages: DataFrame, least: float = LEAST_SEARCHABLE) -> DataFrame:
    """``pages``, unless a document has no text or too little of it."""
    bad = searchable(pages).where((F.col("text_pages") == 0) | (F.col("ratio") < least)).orderBy("relative").first()
    if bad:
        raise ValueError(f"{bad['relative']}: {bad['text_pages']} pages have text (ratio {bad['ratio']:.3f}); it needs character recognition")
    return pages
