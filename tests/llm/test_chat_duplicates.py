"""Calls with one identifier that lie in several segments of a conversation."""

from quarry.llm import chat_format


def call(*ids):
    return '{"tool_calls":[' + ",".join(f'{{"id":"{i}","name":"t","arguments":{{}}}}' for i in ids) + "]}"


def test_duplicates_over_segments(spark):
    rows = [(1, 0, "a"), (1, 300, "a b"), (1, 301, "a"), (1, 900, "b b"), (2, 5, "a"), (None, 1, "a"), (None, 700, "a"), (-1, 700, "a"), (3, None, "a"), (3, -5, "a"), (4, 7, "a"), (4, 7, "a")]
    df = spark.createDataFrame([(c, t, "assistant", call(*ids.split())) for c, t, ids in rows] + [(5, 0, "user", "hi")], "conv_id long, turn long, role string, text string").repartition(3)
    got = {(r["conv_id"], r["segment"]): (r["n_calls"], r["n_duplicate_calls"]) for r in chat_format.format_chats(df).collect()}
    assert got == {
        (1, 0): (1, 0), (1, 1): (3, 2), (1, 3): (2, 2), (2, 0): (1, 0), (None, 0): (1, 0), (None, 2): (1, 1), (-1, 2): (1, 0),
        (3, 0): (1, 0), (3, -1): (1, 1), (4, 0): (2, 1), (5, 0): (0, 0),
    }
