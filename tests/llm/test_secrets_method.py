"""The randomness tests on planted secrets, against a plain false-discovery rule, and in awkward places."""

import math
import random
from collections import defaultdict

import pytest

from quarry.llm import secret_scan

WORDS = "alpha beta gamma delta river mountain config server window release version update manager handler factory buffer".split()


def wordy(rng):
    own = [rng.choice(WORDS) for _ in range(rng.randint(3, 5))]
    return rng.choice([lambda: "-".join(own), lambda: "_".join(own), lambda: "/".join(own), lambda: own[0] + "".join(w.capitalize() for w in own[1:]), lambda: "".join(own) + str(rng.randrange(1000))])()


@pytest.fixture(scope="module")
def planted():
    """(doc_id, text), and where secrets of 32 to 64 characters were planted."""
    rng = random.Random(11)
    docs, secrets = [], {}
    for i in range(1500):
        words = [rng.choice(WORDS) for _ in range(rng.randint(5, 60))] + [wordy(rng) for _ in range(3)]
        rng.shuffle(words)
        if i % 5 == 0:
            letters = secret_scan.ALPHABETS[rng.choice(["base62", "base64-url"])]
            key = "".join(rng.choice(letters) for _ in range(rng.choice([32, 40, 64])))
            before = " ".join(words[: len(words) // 2])
            lead = rng.choice([" ", " (", "https://x.example/v1/keys/"])
            text = f"{before} {lead}{key} end"
            secrets[i] = (text.index(key), text.index(key) + len(key))
        else:
            text = " ".join(words)
        docs.append((i, text))
    return docs, secrets


def test_planted_secrets_are_found_and_joined_words_are_not(spark, planted):
    docs, secrets = planted
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == 3] for r in secret_scan.scan(df).collect()}
    met = sum(any(a <= at and end <= b for a, b in found[i]) for i, (at, end) in secrets.items())
    assert met >= 0.9 * len(secrets)
    wrong = sum(len(found[i]) for i, _ in docs if i not in secrets)
    assert wrong <= 0.02 * sum(map(len, found.values()))


def test_spans_are_those_of_a_plain_false_discovery_rule(spark, planted):
    docs, _ = planted
    tests = [(i, *c) for i, t in docs for c in secret_scan._candidates(t, secret_scan._base(t))]
    want = defaultdict(set)
    for of in {t[3] for t in tests}:
        own = sorted((1.0 if step < 0 else math.exp(-step * secret_scan.STEP), i, a, b) for i, a, b, c, step in tests if c == of)
        last = max((k for k, (p, *_) in enumerate(own, 1) if p <= secret_scan.FALSE_DISCOVERIES * k / len(own)), default=0)
        for _, i, a, b in own[:last]:
            want[i].add((a, b))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: {(s["start"], s["end"]) for s in r["spans"] if s["kind"] == 3} for r in secret_scan.scan(df).collect()}
    assert {i: s for i, s in got.items() if s} == dict(want)


def test_runs_less_base_spans_and_parts_of_paths():
    key = "Zk39fQ8rT2mWx7LpB4vN6yHc1sDgJ0aUe5"
    assert [(a, b) for a, b, *_ in secret_scan._candidates(f"https/x/v1_a/{key}/q", [])] == [(13, 13 + len(key))]
    text = f"{key}token=abcdef123/{key}"
    base = secret_scan._base(text)
    assert base and all(e <= base[0][0] or s >= base[0][2] for s, e, *_ in secret_scan._candidates(text, base))
    many = "password=abcdef12 " * 20_000  # as long as it takes to read, not its square
    assert len(secret_scan._base(many)) == 20_000 and secret_scan._candidates(many, secret_scan._base(many)) == []
    assert secret_scan.mask("ab secret cd", [(3, 0, 9), (3, 2, 7), (5, 1, 9)]) == "ab [assign] cd"
