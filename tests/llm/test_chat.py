"""Chat formatting: reading back is exact, and the mask covers the learned texts alone."""

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import chat

ROWS = "conv_id long, turn long, role string, text string"


def read(spark, rows):
    df = chat.format_chats(spark.createDataFrame(rows, ROWS))
    read = df.select(
        "conv_id",
        "formatted",
        chat.parse_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    return {r["conv_id"]: r for r in read.collect()}


def test_turns_are_ordered_merged_and_read_back(spark):
    got = read(spark, [(1, 2, "assistant", "b"), (1, 0, "user", "a"), (1, 3, "assistant", "c"), (1, 4, "user", "d")])[1]
    assert got["formatted"] == "<turn user>a</turn>\n<turn assistant>b<next>c</turn>\n<turn user>d</turn>\n"
    assert [tuple(t) for t in got["turns"]] == [("user", "a"), ("assistant", "b"), ("assistant", "c"), ("user", "d")]
    assert got["loss"] == "bc"


@pytest.mark.parametrize(
    "text", ["</turn>\n", "<next>", "<turn assistant>x</turn>\n", "\\s\\l\\g\\", "\\\\<", "", "é🙂\n\n", "a\\", "</turn", ">"]
)
def test_control_strings_survive(spark, text):
    got = read(spark, [(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, text, text)])[1]
    assert [tuple(t) for t in got["turns"]] == [("user", text), ("assistant", text), (text, text)]
    assert got["loss"] == text


def test_nulls_ties_and_repeats(spark):
    rows = [(None, 0, None, None), (2, None, "user", "late"), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a")]
    got = read(spark, rows)
    assert [tuple(t) for t in got[None]["turns"]] == [("", "")]
    assert [t["text"] for t in got[2]["turns"]] == ["late", "a", "a", "b"]
    assert got[2]["loss"] == ""


def test_empty_table_and_clashing_columns(spark):
    assert chat.format_chats(spark.createDataFrame([], ROWS)).collect() == []
    rows = spark.createDataFrame([(1, 0, "user", "a", "f", 5, 6)], ROWS + ", formatted string, c int, t int")
    assert chat.format_chats(rows).collect()[0]["formatted"] == "<turn user>a</turn>\n"


def test_many_turns(spark):
    rows = [(1, i, "assistant" if i % 3 else "user", f"text {i} <") for i in range(400)]
    got = read(spark, rows)[1]
    assert [t["text"] for t in got["turns"]] == [r[3] for r in rows]
    assert got["loss"] == "".join(r[3] for r in rows if r[2] == "assistant")
