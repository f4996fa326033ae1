"""Chat formatting: conversations as one training string with a loss mask.

A run of adjacent turns of one role becomes ``<turn ROLE>text</turn>`` and a line break; the turns
of a run are parted by ``<next>``. In roles and texts ``\\``, ``<`` and ``>`` are written ``\\s``,
``\\l`` and ``\\g``, so angle brackets in the output are always marks and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, NEXT, END = "<turn ", ">", "<next>", "</turn>\n"
_ESCAPES = (("\\", "\\s"), ("<", "\\l"), (">", "\\g"))


def escaped(text: Column) -> Column:
    """A text without any control character of the template."""
    for plain, code in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``."""
    for plain, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _runs(turns: Column) -> Column:
    """Maximal runs of turns of one role: array of (role, texts)."""
    n = F.size(turns)
    at = F.sequence(F.lit(1), n)
    starts = F.when(n == 0, F.array().cast("array<int>")).otherwise(
        F.filter(at, lambda i: (i == 1) | (F.get(turns, i - 1)["role"] != F.get(turns, i - 2)["role"]))
    )
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(n + 1))
    return F.zip_with(
        starts,
        F.slice(ends, 1, F.greatest(F.size(starts), F.lit(1))),
        lambda a, b: F.struct(
            F.get(turns, a - 1)["role"].alias("role"),
            F.transform(F.slice(turns, a, b - a), lambda t: escaped(t["text"])).alias("texts"),
        ),
    )


def format_chats(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: conv, ``formatted`` and ``loss_spans`` (array of start, length).

    Spans count code points of ``formatted`` from 0; each covers one text of ``learn_role``, and no
    mark. Turns are ordered by turn, then role, then text; a null turn comes first. Repeated rows are
    repeated turns. A null role or text is empty. A null conversation id is one conversation of its
    own. Other columns are ignored, whatever their names. An empty table gives no rows.

    A conversation becomes one string, so its turns meet in one row by definition of the result.
    """
    rows = conversations.select(
        F.col(conv).alias("c"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    grouped = rows.groupBy("c").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    runs = grouped.select("c", _runs(F.col("turns")).alias("runs"))
    # Each run as marks and texts; a flag tells the texts that are learned.
    pieces = F.flatten(
        F.transform(
            "runs",
            lambda r: F.concat(
                F.array(_piece(F.concat(F.lit(OPEN), escaped(r["role"]), F.lit(CLOSE)), F.lit(False))),
                F.flatten(
                    F.transform(
                        r["texts"],
                        lambda x, i: F.concat(
                            F.when(i > 0, F.array(_piece(F.lit(NEXT), F.lit(False)))).otherwise(
                                F.filter(F.array(_piece(F.lit(""), F.lit(False))), lambda _: F.lit(False))
                            ),
                            F.array(_piece(x, r["role"] == learn_role)),
                        ),
                    )
                ),
                F.array(_piece(F.lit(END), F.lit(False))),
            ),
        )
    )
    cut = runs.select("c", pieces.alias("p"))
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")
    )
    spans = F.aggregate(
        "p",
        start,
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["s"])).alias("at"),
            F.when(
                x["learn"],
                F.concat(
                    acc["spans"],
                    F.array(F.struct(acc["at"].alias("start"), F.length(x["s"]).alias("length"))),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return cut.select(
        F.col("c").alias(conv),
        F.array_join(F.transform("p", lambda x: x["s"]), "").alias("formatted"),
        spans.alias("loss_spans"),
    )


def _piece(text: Column, learn: Column) -> Column:
    return F.struct(text.alias("s"), learn.alias("learn"))


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, read back: array of (role, text)."""
    runs = F.filter(F.split(formatted, F.lit(END)), lambda r: r != "")
    return F.flatten(
        F.transform(
            runs,
            lambda r: F.transform(
                # What follows the head; an array element per text of the run.
                F.split(F.substring(r, F.instr(r, CLOSE) + 1, F.length(r)), F.lit(NEXT)),
                lambda x: F.struct(
                    unescaped(F.substring(r, F.lit(len(OPEN) + 1), F.instr(r, CLOSE) - len(OPEN) - 1)).alias(
                        "role"
                    ),
                    unescaped(x).alias("text"),
                ),
            ),
        )
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["length"]))), ""
    )
