"""Operator 8: chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: the formatted turns before
it as context, then the turn itself, of which only the text is trainable. Turns
behind the last assistant turn have no reply to train on; they are kept in a
closing example without a target, so the output holds every turn.

Template, per turn: ``<|start|>{role}<|text|>{text}<|end|>``. Inside roles and
texts ``&``, ``<`` and ``[`` are written as character references, so no text can
hold a control string of this or a similar template, and the writing is undone
exactly.

A conversation is formatted in one row, as its examples are; contexts repeat the
turns before them, which is what the method asks for. DataFrame functions only.

Defined results: rows are ordered by turn (null first), ties by role, then text;
repeated rows are turns of their own; a null role or text is empty; null
conversation ids form one conversation; conversations without an assistant turn
give only the closing example; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings, and the references that texts get instead.
START, BODY, END = "<|start|>", "<|text|>", "<|end|>"
REFERENCES = {"&": "&amp;", "<": "&lt;", "[": "&lsqb;"}
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    for char, reference in REFERENCES.items():
        text = F.replace(text, F.lit(char), F.lit(reference))
    return text


def unescaped(text: Column) -> Column:
    for char, reference in reversed(REFERENCES.items()):
        text = F.replace(text, F.lit(reference), F.lit(char))
    return text


def formatted_turn(turn: Column) -> Column:
    return F.concat(F.lit(START), escaped(turn["role"]), F.lit(BODY), escaped(turn["text"]), F.lit(END))


def expand(conversations: DataFrame) -> DataFrame:
    """``conv_id, example, closes, formatted, loss_start, loss_end``, an example
    a row; ``closes`` marks a conversation's last one, which holds all turns.

    The loss mask is ``[loss_start, loss_end)`` in code points of ``formatted``;
    it is null in a closing example without a target.
    """
    c = conversations
    rows = c.select(
        c["conv_id"].cast("long").alias("conv_id"), c["turn"].cast("long").alias("turn"),
        F.coalesce(c["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(c["text"].cast("string"), F.lit("")).alias("text"),
    )
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    pieces = turns.select("conv_id", F.col("turns.role").alias("roles"), F.transform("turns", formatted_turn).alias("pieces"))
    # Where each turn ends in the whole conversation; an example is its beginning.
    ends = F.aggregate(
        F.transform("pieces", F.length), F.array().cast("array<int>"),
        lambda acc, n: F.concat(acc, F.array(n + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)))),
    )
    placed = pieces.select("conv_id", F.array_join("pieces", "").alias("whole"), F.arrays_zip(
        F.col("roles").alias("role"), F.transform("pieces", F.length).alias("size"), ends.alias("end")
    ).alias("turns"))
    last = F.size("turns") - 1
    numbered = F.transform("turns", lambda t, i: F.struct(t["size"].alias("size"), t["end"].alias("end"), (t["role"] == ASSISTANT).alias("trains"), (i == last).alias("closes")))
    wanted = F.filter(numbered, lambda t: t["trains"] | t["closes"])
    head = len(START + ASSISTANT + BODY)
    return (
        placed.select("conv_id", "whole", F.posexplode(wanted).alias("example", "t"))
        .select(
            "conv_id", "example", F.col("t.closes").alias("closes"), F.left("whole", F.col("t.end")).alias("formatted"),
            F.when(F.col("t.trains"), F.col("t.end") - F.col("t.size") + head).alias("loss_start"),
            F.when(F.col("t.trains"), F.col("t.end") - len(END)).alias("loss_end"),
        )
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the formatted examples alone: its turns and what
    the loss mask covers, as counts and SHA-256 digests."""
    size = F.col("loss_end") - F.col("loss_start")
    target = F.when(size > 0, unescaped(F.substring(F.col("formatted"), F.col("loss_start") + 1, size))).otherwise("")
    # Only the closing example holds all turns; the others pass on their target alone.
    read = examples.select(
        "conv_id", "example", F.when(F.col("closes"), F.col("formatted")).alias("whole"),
        target.alias("target"), F.length("formatted").cast("long").alias("chars"),
    )
    by_conv = read.groupBy("conv_id").agg(
        F.max("whole").alias("whole"), F.sum("chars").alias("formatted_chars"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "target"))), lambda x: x["target"]), "").alias("loss"),
    )
    # One split per conversation; what follows a start mark is one turn.
    parts = F.split("whole", r"<\|start\|>")
    turns = by_conv.withColumn("turns", F.filter(parts, lambda part, i: i > 0))

    def content(turn: Column) -> Column:
        role, text = F.substring_index(turn, BODY, 1), F.substring_index(F.substring_index(turn, BODY, -1), END, 1)
        return F.concat(unescaped(role), F.lit("\n"), unescaped(text), F.lit("\n"))

    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", content), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
