"""Thousands of made conversations against a plain version, and texts that are hostile to a JSON reader."""

import json
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import plain

from quarry.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string"


def made(n, rng):
    rows = []
    for conv in range(n):
        turns = rng.sample(range(60), rng.randint(1, 14))
        for turn in turns:
            kind, of = rng.random(), f"c{rng.randrange(6)}"
            if kind < 0.3:
                rows.append((conv, turn, "user", rng.choice(["hi", "", "né\n\"q\"", "{\"a\":1}"])))
            elif kind < 0.65:
                calls = []
                for _ in range(rng.randint(0, 3)):
                    arguments = rng.choice([{"query": "x"}, {"query": "", "limit": 3}, {"query": "y", "limit": rng.choice([1, 50, 51, True])}, {"document_id": "d"}, "{\"query\":\"z\"}", "no json", [], {"query": "q", "more": 1}])
                    calls.append({"id": f"c{rng.randrange(6)}", "name": rng.choice(["search", "fetch", "other"]), "arguments": arguments, **({"type": "function"} if rng.random() < 0.3 else {})})
                rows.append((conv, turn, "assistant", json.dumps({"tool_calls": calls, **({"content": "so", "name": "bot"} if rng.random() < 0.5 else {})})))
            elif kind < 0.95:
                rows.append((conv, turn, "tool", json.dumps({"tool_call_id": of, "content": rng.choice([None, 1, {"z": 1, "a": [True]}]), **({"is_error": False} if rng.random() < 0.3 else {})})))
            else:
                rows.append((conv, turn, rng.choice(["tool", "assistant"]), rng.choice(["{bad", "[1]", "{\"x\": NaN}", None])))
    return rows


def same(got, want):
    assert {(r["conv_id"], r["segment"], r["piece"]) for r in got} == set(want)
    for r in got:
        n, counts, messages = want[r["conv_id"], r["segment"], r["piece"]]
        assert r["n_messages"] == n and {k: r[k] for k in counts} == counts
        assert r["chat"] == chat_format.canonical(messages)


@pytest.mark.parametrize(("turns", "most"), [(256, 1024), (16, 3)])
def test_made_conversations(spark, turns, most):
    rows = made(3000, random.Random(turns))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    same(chat_format.format_chats(df, chat_format.TOOLS, turns, most).collect(), plain.chats(rows, chat_format.TOOLS, turns, most))


def test_rows_without_turns_are_put_out_in_pieces(spark):
    rows = [(1, None, "user", f"m{i}") for i in range(500)] + [(None, 3, "user", "same")] * 300 + [(2, 0, "user", "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = chat_format.format_chats(df, segment_rows=64).collect()
    of = {c: sorted((r["piece"], r["n_messages"]) for r in got if r["conv_id"] == c) for c in (1, None, 2)}
    assert of == {1: [(k, 64) for k in range(7)] + [(7, 52)], None: [(k, 64) for k in range(4)] + [(4, 44)], 2: [(0, 1)]}
    assert sorted(m["content"] for r in got if r["conv_id"] == 1 for m in json.loads(r["chat"])) == sorted(f"m{i}" for i in range(500))


HOSTILE = [
    "{\"tool_calls\":[{\"id\":\"\\ud800\",\"name\":\"search\",\"arguments\":{\"query\":\"\\udfff\"}}]}",
    "{\"tool_calls\":[{\"id\":\"a\",\"name\":\"search\",\"arguments\":\"" + "[" * 200_000 + "\"}]}",
    "{\"tool_calls\":" + "[" * 100_000,
    "{\"tool_calls\":[{\"id\":\"n\",\"name\":\"search\",\"arguments\":{\"limit\":NaN}}]}",
    "{\"tool_calls\":[{\"id\":\"i\",\"name\":\"search\",\"arguments\":{\"limit\":1e999}}]}",
    "{\"tool_calls\":[{\"id\":\"big\",\"name\":\"search\",\"arguments\":{\"limit\":" + "9" * 5000 + "}}]}",
    "{\"tool_calls\":[{\"id\":\"x\",\"name\":\"search\",\"arguments\":{\"\\ud800\":1,\"query\":\"q\"}}],\"role\":\"system\"}",
    "{\"tool_calls\":[{\"id\":1,\"name\":\"search\"}]}",
    "{" + "x" * 3_000_000,
]


def test_hostile_texts_come_out_as_json(spark):
    rows = [(k, 0, "assistant", t) for k, t in enumerate(HOSTILE)] + [(0, 1, "tool", "{\"tool_call_id\":\"\\ud800\"}")]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("x", "x").selectExpr("*", "'c' AS message", "1 AS segment", "2 AS at", "'l' AS link")
    got = {r["conv_id"]: r for r in chat_format.format_chats(df, chat_format.TOOLS).collect()}
    chats = {k: json.loads(r["chat"], parse_constant=lambda name: pytest.fail(name)) for k, r in got.items()}
    assert len(got) == len(HOSTILE) and got[0]["n_linked"] == 1 and got[0]["n_valid_calls"] == 1
    assert chats[0][0]["tool_calls"][0]["id"] == "\ud800"
    assert got[1]["n_calls"] == 1 and got[1]["n_valid_calls"] == 0
    for k in (2, 3, 4, 5, 7, 8):
        assert chats[k][0]["content"] == HOSTILE[k] and got[k]["n_calls"] == 0
    assert chats[6][0]["role"] == "assistant" and got[6]["n_valid_calls"] == 0


def test_equal_rows_are_told_apart(spark):
    call = json.dumps({"tool_calls": [{"id": "a", "name": "fetch", "arguments": {"document_id": "d"}}]})
    result = json.dumps({"tool_call_id": "a", "content": 1})
    df = spark.createDataFrame([(1, 1, "assistant", call)] * 3 + [(1, 2, "tool", result)] * 3, SCHEMA).repartition(3)
    [r] = chat_format.format_chats(df, chat_format.TOOLS).collect()
    assert (r["n_messages"], r["n_calls"], r["n_duplicate_calls"], r["n_linked"], r["n_repeated"]) == (6, 3, 2, 1, 2)


def test_the_query_reaches_the_hash_joins(spark, sf):
    from quarry.llm import queries

    found = queries.op10_chat_format(spark, sf)
    assert "ShuffledHashJoin" in found._jdf.queryExecution().executedPlan().toString()
    totals = found.selectExpr("sum(n_calls)", "sum(n_valid_calls)", "sum(n_linked)", "sum(n_orphans)").first()
    assert all(n > 0 for n in totals)
