"""Chat formatting with linked tool calls.

A message is a row (conv_id, turn, role, text). An assistant's text that is a JSON object with ``tool_calls``, a list
of ``{"id", "name", "arguments"}``, makes calls; a tool's text that is a JSON object with ``tool_call_id`` is a
result. Texts are parsed once. Calls and results meet in a hash join on conversation and identifier. Messages are put
in topological order: by turn, except that a result that stands before its call is moved behind it. Arguments are
validated against the schema of the tool's name, and every message is serialised as canonical JSON (sorted keys, no
blanks, UTF-8). Members that are not known, of messages and of calls, are kept; a member ``role`` gives way to the
row's role.

A conversation is put out in segments of ``segment_turns`` turns, and a segment of more than ``segment_rows`` messages
(many rows of one turn, or of none) in pieces of so many. Messages of such segments are numbered over range
partitions, so that no task holds a conversation, and no task reads all rows of one.

Cases: a null text or role counts as empty; a null turn comes first, in segment 0; null conv_ids form one
conversation; of calls with one identifier in a conversation the first is linked and the others are ``duplicate``; a
result without a call is an ``orphan``, a second result ``repeated``; text that looks like JSON and is none, numbers
that are not finite and nesting that is too deep included, stays text; half of a surrogate pair is written as its
escape; of members given twice in an object the last counts; arguments that are no JSON stay a string and are
invalid; equal rows are put out each, and of equal calls or results the first counts as such; very long texts are one
message; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import math
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.runtime import ship, shuffle_partitions, stored

SEGMENT_TURNS = 256
SEGMENT_ROWS = 1024
_HALF_PAIR = re.compile("[\ud800-\udfff]")


def canonical(value: Any) -> str:
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return _HALF_PAIR.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def _finite(digits: str) -> float:
    value = float(digits)
    if not math.isfinite(value):
        raise ValueError(f"{digits} is out of range")
    return value


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def read_json(text: str) -> Any:
    """As the standard has it; ValueError where the text is none, nesting that is too deep included."""
    try:
        value = json.loads(text, parse_float=_finite, parse_constant=_no_constant)
        canonical(value)
    except RecursionError:
        raise ValueError("nested too deeply") from None
    return value


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value: Any, kind: str) -> bool:
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool)
    if kind == "number":
        return isinstance(value, int | float) and not isinstance(value, bool)
    return isinstance(value, _TYPES[kind])


def violations(value: Any, schema: dict, at: str = "$") -> list[str]:
    """What a value lacks of a JSON schema: type, enum, required, properties, additionalProperties, items, bounds."""
    kinds = schema.get("type")
    if kinds and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: not {kinds}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not in enum")
    if isinstance(value, int | float) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            found.append(f"{at}: out of bounds")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        found.append(f"{at}: length")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                found += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            found += violations(x, schema["items"], f"{at}[{i}]")
    return found


def check_call(call: dict, schemas: dict[str, dict]) -> tuple[Any, str]:
    """The arguments as a value, and ``valid``, ``unknown_tool`` or what is wrong."""
    arguments = call.get("arguments", {})
    if isinstance(arguments, str):
        try:
            arguments = read_json(arguments)
        except ValueError:
            return arguments, "arguments are no JSON"
    if call["name"] not in schemas:
        return arguments, "unknown_tool"
    return arguments, "; ".join(violations(arguments, schemas[call["name"]])) or "valid"


def parse(role: str, text: str, schemas: dict[str, dict]) -> tuple[str, list[tuple[str, str]], str | None]:
    """(the message as canonical JSON, identifier and check of each call, identifier that this is the result of);
    identifiers are canonical JSON, too."""
    if role in ("assistant", "tool") and text[:1] == "{":
        try:
            body = read_json(text)
            if role == "tool" and isinstance(body.get("tool_call_id"), str):
                return canonical({"content": None, **body, "role": role}), [], canonical(body["tool_call_id"])
            calls = body.get("tool_calls")
            if role == "assistant" and isinstance(calls, list) and all(isinstance(c, dict) and isinstance(c.get("id"), str) and isinstance(c.get("name"), str) for c in calls):
                checked = [check_call(c, schemas) for c in calls]
                body["tool_calls"] = [{**c, "arguments": arguments} for c, (arguments, _) in zip(calls, checked, strict=True)]
                found = [(canonical(c["id"]), _HALF_PAIR.sub("�", said)) for c, (_, said) in zip(calls, checked, strict=True)]
                return canonical({"content": None, **body, "role": role}), found, None
        except (ValueError, RecursionError):
            pass
    return canonical({"content": text, "role": role}), [], None


_CALL = pa.list_(pa.struct([("id", pa.string()), ("check", pa.string())]))


def _parsed(schemas: dict[str, dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parse(role, text, schemas) for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            calls = [[{"id": i, "check": said} for i, said in made] for _, made, _ in found]
            kept = ["conv_id", "turn", "row"]
            columns = [pa.array([m for m, _, _ in found], pa.string()), pa.array(calls, _CALL), pa.array([of for _, _, of in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), *columns], names=[*kept, "message", "calls", "result_of"])

    return run


def _rows(conversations: DataFrame, schemas: dict[str, dict] | None) -> DataFrame:
    """One row per message, parsed and stored; ``at`` tells equal rows apart."""
    ship(conversations.sparkSession)
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("row", F.xxhash64("role", "text"))
    call = T.StructType([T.StructField("id", T.StringType()), T.StructField("check", T.StringType())])
    more = [T.StructField("message", T.StringType()), T.StructField("calls", T.ArrayType(call)), T.StructField("result_of", T.StringType())]
    schema = T.StructType([rows.schema["conv_id"], rows.schema["turn"], rows.schema["row"], *more])
    return stored(rows.mapInArrow(_parsed(schemas or {}), schema).withColumn("at", F.monotonically_increasing_id()), "messages")


def _matches(*pairs: tuple[str, str]) -> Column:
    """Equal in every pair of columns, nulls included."""
    return functools.reduce(lambda x, y: x & y, (F.col(a).eqNullSafe(F.col(b)) for a, b in pairs))


def _placed(parsed: DataFrame) -> DataFrame:
    """Every message with its place in the topological order, ``link`` of results and its number of duplicate calls."""
    calls = parsed.where(F.size("calls") > 0).select("conv_id", "turn", "row", "at", F.posexplode("calls").alias("place", "call"))
    calls = calls.select("conv_id", "turn", "row", "at", "place", F.col("call.id").alias("id"))
    first = calls.groupBy(F.col("conv_id").alias("first_conv"), F.col("id").alias("first_id")).agg(F.min(F.struct("turn", "row", "at", "place")).alias("first"))
    results = parsed.where(F.col("result_of").isNotNull())
    earliest = results.groupBy(F.col("conv_id").alias("of_conv"), F.col("result_of").alias("of_id")).agg(F.min(F.struct("turn", "row", "at")).alias("earliest"))

    known = earliest.join(first.hint("shuffle_hash"), _matches(("of_conv", "first_conv"), ("of_id", "first_id")), "left").select(
        "of_conv", "of_id", F.col("earliest.at").alias("earliest_at"), F.col("first").isNotNull().alias("has_call"), F.col("first.turn").alias("call_turn")
    )
    linked = results.join(known.hint("shuffle_hash"), _matches(("conv_id", "of_conv"), ("result_of", "of_id"))).select(
        "conv_id", "turn", "row", "at", "message", "calls",
        F.greatest("turn", "call_turn").alias("order_turn"),
        (F.col("has_call") & (F.col("turn").isNull() | F.coalesce(F.col("call_turn") >= F.col("turn"), F.lit(False)))).alias("moved"),
        F.when(~F.col("has_call"), "orphan").when(F.col("at") == F.col("earliest_at"), "linked").otherwise("repeated").alias("link"),
    )
    plain = parsed.where(F.col("result_of").isNull()).drop("result_of").withColumns({"order_turn": F.col("turn"), "moved": F.lit(False), "link": F.lit(None).cast("string")})
    both = plain.unionByName(linked)

    again = calls.join(first.hint("shuffle_hash"), _matches(("conv_id", "first_conv"), ("id", "first_id")))
    again = again.where((F.col("at") != F.col("first.at")) | (F.col("place") != F.col("first.place")))
    again = stored(again.groupBy("at").agg(F.count(F.lit(1)).alias("n_duplicates")), "duplicate-calls")
    return both.join(again, "at", "left").withColumn("n_duplicates", F.coalesce("n_duplicates", F.lit(0)).cast("long"))


def messages(conversations: DataFrame, schemas: dict[str, dict] | None = None) -> DataFrame:
    """One row per message: conv_id, turn, row, at, message, calls, order_turn, moved, link, n_duplicates. ``order_turn``,
    ``moved``, ``turn``, ``row`` and ``at`` give the topological order; ``link`` tells of a result ``linked``,
    ``orphan`` or ``repeated``."""
    return _placed(_rows(conversations, schemas))


_ORDER = ("order_turn", "moved", "turn", "row", "at")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation and segment: their numbers within these, as far as this partition knows."""
    part, total, key, opening, n = TaskContext.get().partitionId(), 0, None, None, 0
    for batch in batches:
        numbers, first = [], []
        for here in zip(batch.column("conv_id").to_pylist(), batch.column("segment").to_pylist(), strict=True):
            if here != key:
                key, n = here, 0
                opening = opening or here
            numbers.append(n)
            first.append(here == opening)
            n += 1
        size = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * size, pa.int32()), pa.array(range(total, total + size), pa.int64()), pa.array(numbers, pa.int64()), pa.array(first, pa.bool_())],
            names=[*batch.schema.names, "part", "place", "n", "first"],
        )
        total += size


def _pieces(rows: DataFrame, segment_rows: int) -> DataFrame:
    """``at`` and ``piece``: rows in order, ``segment_rows`` of a segment to a piece. Each range partition numbers its
    own rows; where one begins within a segment, the rows that earlier partitions hold of it are added."""
    spark = rows.sparkSession
    keys = ["conv_id", "segment", *_ORDER]
    thin = stored(rows.select(*keys), "segment-keys")
    ranged = thin.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys).select("conv_id", "segment", "at")
    schema = T.StructType([*ranged.schema, *(T.StructField(n, t) for n, t in (("part", T.IntegerType()), ("place", T.LongType()), ("n", T.LongType()), ("first", T.BooleanType())))])
    numbered = stored(ranged.mapInArrow(_counted, schema), "segment-numbers")
    key = F.struct("conv_id", "segment")
    ends = numbered.groupBy("part").agg(F.min_by(key, "place").alias("head"), F.max_by(key, "place").alias("tail"), F.max_by("n", "place").alias("last"))
    before, carried, of = [], 0, None
    for r in sorted(ends.collect(), key=lambda r: r["part"]):  # one row a partition
        start = carried if r["head"] == of else 0
        before.append((r["part"], start))
        carried, of = r["last"] + 1 + (start if r["tail"] == r["head"] else 0), r["tail"]
    starts = spark.createDataFrame(before, "part int, start long")
    number = F.col("n") + F.when(F.col("first"), F.col("start")).otherwise(0)
    return numbered.join(F.broadcast(starts), "part").select("at", F.floor(number / segment_rows).cast("long").alias("piece"))


def format_chats(conversations: DataFrame, schemas: dict[str, dict] | None = None, segment_turns: int = SEGMENT_TURNS, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row per segment, or piece of a large one: conv_id, segment, piece, n_messages, n_calls, n_valid_calls,
    n_duplicate_calls, n_linked, n_orphans, n_repeated, chat (canonical JSON: a list of messages)."""
    found = messages(conversations, schemas).withColumn("segment", F.coalesce(F.floor(F.col("order_turn") / segment_turns), F.lit(0)).cast("long"))
    full = found.groupBy("conv_id", "segment").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > segment_rows)
    full = stored(full.select(F.col("conv_id").alias("full_conv"), F.col("segment").alias("full_segment")), "large-segments")
    usual = found.withColumn("piece", F.lit(0).cast("long"))
    if not full.isEmpty():
        usual = found.join(full, _matches(("conv_id", "full_conv"), ("segment", "full_segment")), "left_anti").withColumn("piece", F.lit(0).cast("long"))
        large = found.join(full, _matches(("conv_id", "full_conv"), ("segment", "full_segment")), "left_semi")
        usual = usual.unionByName(large.join(_pieces(large, segment_rows), "at"))
    number = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("int")).cast("long")
    return usual.groupBy("conv_id", "segment", "piece").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.sum(F.size("calls")).cast("long").alias("n_calls"),
        F.sum(F.size(F.filter("calls", lambda c: c["check"] == "valid"))).cast("long").alias("n_valid_calls"),
        F.sum("n_duplicates").alias("n_duplicate_calls"),
        number(F.col("link") == "linked").alias("n_linked"),
        number(F.col("link") == "orphan").alias("n_orphans"),
        number(F.col("link") == "repeated").alias("n_repeated"),
        F.concat(F.lit("["), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*_ORDER, "message"))), lambda m: m["message"]), ","), F.lit("]")).alias("chat"),
    )


#: Schemas of the tools that the registered query knows.
TOOLS = {
    "search": {"type": "object", "required": ["query"], "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 50}}, "additionalProperties": False},
    "fetch": {"type": "object", "required": ["document_id"], "properties": {"document_id": {"type": "string"}}, "additionalProperties": False},
}


def with_tools(conversations: DataFrame) -> DataFrame:
    """Tool traffic made of every assistant's turn, as the supplied table has none: the turn calls ``search``, or every
    third one ``fetch`` with a number for a name, and the tool answers with the text, one turn in four before the call
    and one in seven to a call that nobody made. Turns are spread so that no two rows share one."""
    turn, text = F.col("turn").cast("long"), F.coalesce("text", F.lit(""))
    every = conversations.select("conv_id", (turn * 4).alias("turn"), "role", "text")
    made = conversations.where("role = 'assistant'")
    call = F.when(
        turn % 3 == 2, F.concat(F.lit('{"id":"c'), turn.cast("string"), F.lit('","name":"fetch","arguments":{"document_id":'), turn.cast("string"), F.lit("}}"))
    ).otherwise(F.concat(F.lit('{"name":"search","id":"c'), turn.cast("string"), F.lit('","arguments":{"query":'), _quoted(text), F.lit(',"limit":'), turn.cast("string"), F.lit("}}")))
    calls = made.select("conv_id", (turn * 4 + 1).alias("turn"), "role", F.concat(F.lit('{"tool_calls":['), call, F.lit('],"reasoning":"r"}')).alias("text"))
    of = F.when(turn % 7 == 6, F.lit("nobody")).otherwise(F.concat(F.lit("c"), turn.cast("string")))
    answers = made.select(
        "conv_id", F.when(turn % 4 == 1, turn * 4 - 1).otherwise(turn * 4 + 2).alias("turn"), F.lit("tool").alias("role"), F.concat(F.lit('{"tool_call_id":"'), of, F.lit('","content":'), _quoted(text), F.lit("}")).alias("text")
    )
    return every.unionByName(calls).unionByName(answers)


def _quoted(text: Column) -> Column:
    """As a JSON string."""
    whole = F.to_json(F.struct(text.alias("t")))  # {"t":"..."}
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


SQL = f"""
WITH e AS (SELECT conv_id, CAST(turn AS BIGINT) AS t, role, coalesce(text, '') AS text FROM conversations),
a AS (SELECT * FROM e WHERE role = 'assistant'),
m AS (
  SELECT conv_id, t * 4 AS order_turn, 0 AS moved, t * 4 AS turn, 0 AS n_calls, 0 AS n_valid, 0 AS n_linked, 0 AS n_orphans,
         '{{"content":' || to_json(text) || ',"role":' || to_json(coalesce(role, '')) || '}}' AS message FROM e
  UNION ALL
  SELECT conv_id, t * 4 + 1, 0, t * 4 + 1, 1, CASE WHEN t % 3 <> 2 AND text <> '' AND t BETWEEN 1 AND 50 THEN 1 ELSE 0 END, 0, 0,
         '{{"content":null,"reasoning":"r","role":"assistant","tool_calls":[{{"arguments":{{' ||
         CASE WHEN t % 3 = 2 THEN '"document_id":' || t || '}},"id":"c' || t || '","name":"fetch"}}]}}'
              ELSE '"limit":' || t || ',"query":' || to_json(text) || '}},"id":"c' || t || '","name":"search"}}]}}' END FROM a
  UNION ALL
  SELECT conv_id, CASE WHEN t % 4 = 1 THEN CASE WHEN t % 7 = 6 THEN t * 4 - 1 ELSE t * 4 + 1 END ELSE t * 4 + 2 END, CASE WHEN t % 4 = 1 AND t % 7 <> 6 THEN 1 ELSE 0 END,
         CASE WHEN t % 4 = 1 THEN t * 4 - 1 ELSE t * 4 + 2 END, 0, 0, CASE WHEN t % 7 = 6 THEN 0 ELSE 1 END, CASE WHEN t % 7 = 6 THEN 1 ELSE 0 END,
         '{{"content":' || to_json(text) || ',"role":"tool","tool_call_id":"' || CASE WHEN t % 7 = 6 THEN 'nobody' ELSE 'c' || t END || '"}}' FROM a
)
SELECT conv_id, CAST(floor(order_turn / {SEGMENT_TURNS}) AS BIGINT) AS segment, CAST(0 AS BIGINT) AS piece, count(*) AS n_messages,
       CAST(sum(n_calls) AS BIGINT) AS n_calls, CAST(sum(n_valid) AS BIGINT) AS n_valid_calls, CAST(0 AS BIGINT) AS n_duplicate_calls,
       CAST(sum(n_linked) AS BIGINT) AS n_linked, CAST(sum(n_orphans) AS BIGINT) AS n_orphans, CAST(0 AS BIGINT) AS n_repeated,
       '[' || string_agg(message, ',' ORDER BY order_turn, moved, turn) || ']' AS chat
FROM m GROUP BY ALL
"""
