"""The registry of data sets and models: what a valid entry is, storage totals, and the choice of a model."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How data sets are acquired, and the stages that they pass.
STAGES = "planned downloaded validated extracted parsed indexed evaluated".split()
METHODS = "http http-file-set http-catalog-file-set http-site-mirror git rsync official-export manual".split()


def dataset_problems(entry: Mapping) -> list[str]:
    found = [f"{k} is missing" for k in ("id", "title", "license") if not str(entry.get(k) or "").strip()]
    if not re.fullmatch(r"[a-z0-9][a-z0-9._-]*", str(entry.get("id", ""))):
        found.append("id has other signs than small letters, digits, dots and dashes")
    if entry.get("stage") not in STAGES:
        found.append("stage is unknown")
    if entry.get("acquisition") not in METHODS:
        found.append("acquisition is unknown")
    for name in ("download_bytes", "extracted_bytes", "index_bytes"):
        size = entry.get(name, 0)
        if isinstance(size, bool) or not isinstance(size, int) or size < 0:
            found.append(f"{name} is no size")
    return found


def registry_problems(entries: Sequence[Mapping]) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for entry in entries:
        name = str(entry.get("id"))
        wrong = dataset_problems(entry) + (["id repeats"] if name in found else [])
        found[name] = found.get(name, []) + wrong
    return {name: wrong for name, wrong in found.items() if wrong}


def storage_summary(spark: SparkSession, entries: Sequence[Mapping]) -> DataFrame:
    rows = [(e["stage"], *(int(e.get(n, 0)) for n in ("download_bytes", "extracted_bytes", "index_bytes"))) for e in entries]
    df = spark.createDataFrame(rows, "stage string, download_bytes long, extracted_bytes long, index_bytes long")
    return df.groupBy("stage").agg(F.count(F.lit(1)).alias("datasets"), *(F.sum(c).alias(c) for c in df.columns[1:]))


def choose_model(models: Sequence[Mapping], role: str) -> Mapping:
    """Of a role's enabled models the one of the least priority number, then of the least id."""
    fit = [m for m in models if role in m.get("roles", ()) and m.get("enabled", True)]
    if not fit:
        raise LookupError(f"no model for {role}")
    return min(fit, key=lambda m: (m.get("priority", 0), m["id"]))
