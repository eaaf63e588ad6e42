"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context and
only its text is under the loss mask. If a conversation does not end with an assistant
turn, one more example holds the whole of it with nothing to train on, so that the
output gives back every turn.

The template of a turn is ``<s>[INST]role[/INST]text</s>``. Inside roles and texts the
control strings are escaped reversibly: each backslash is doubled, then a backslash is
put after the first character of each control string. An escaped text thus holds no
control string, and ``unescape`` gives back exactly what went in.

All of it is built-in expressions over one row a conversation; the output of n assistant
turns grows with n squared by the method's nature, but is streamed example by example.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings of the template (fixed values).
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def chat_examples(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target_role: str = "assistant") -> DataFrame:
    """One row an example: conv_id, example (from 0), target_turn (index, or -1), text, loss_start, loss_length.

    Positions are code points. Turns are ordered by (turn, role, text), nulls first, so
    ties and repeated rows have one defined order; null roles and texts are empty; rows
    with a null conv_id make up one conversation, whose id is null. Other columns of the
    table are not read, whatever their names. No turns: no rows.
    """
    c = {k: F.col(f"`{v}`") for k, v in (("conv", conv_id), ("turn", turn), ("role", role), ("text", text))}
    rows = turns.select(
        c["conv"].alias("conv_id"),
        F.struct(c["turn"].alias("turn"), F.coalesce(c["role"], F.lit("")).alias("role"), F.coalesce(c["text"], F.lit("")).alias("text")).alias("t"),
    )
    one = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    shaped = one.select(
        "conv_id",
        F.transform("ts", lambda t: F.concat(F.lit("<s>[INST]"), escape(t["role"]), F.lit("[/INST]"))).alias("heads"),
        F.transform("ts", lambda t: escape(t["text"])).alias("bodies"),
        F.transform("ts", lambda t: t["role"] == target_role).alias("is_target"),
    )
    last = F.size("bodies") - 1
    targets = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("is_target", i))
    tail = F.when(~F.get("is_target", last), F.array(F.lit(-1))).otherwise(F.array().cast("array<int>"))
    each = shaped.select("conv_id", "heads", "bodies", F.posexplode(F.concat(targets, tail)).alias("example", "target_turn"))
    upto = F.when(F.col("target_turn") < 0, F.size("bodies")).otherwise(F.col("target_turn") + 1)
    whole = F.zip_with(F.slice("heads", 1, upto), F.slice("bodies", 1, upto), lambda h, b: F.concat(h, b, F.lit("</s>")))
    out = each.select("conv_id", F.col("example").cast("int"), F.col("target_turn").cast("int"), F.array_join(whole, "").alias("text"), F.get("bodies", "target_turn").alias("body"))
    length = F.coalesce(F.length("body"), F.lit(0))
    return out.select(
        "conv_id", "example", "target_turn", "text",
        F.when(F.col("target_turn") >= 0, F.length("text") - len("</s>") - length).otherwise(0).cast("int").alias("loss_start"),
        length.cast("int").alias("loss_length"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """What the formatted examples say: conv_id, example, turns (role and text, unescaped), loss_text, n_chars."""

    def parsed(turn: Column) -> Column:
        body = F.substring(turn, F.lit(len("<s>[INST]") + 1), F.length(turn))
        return F.struct(
            unescape(F.substring_index(body, "[/INST]", 1)).alias("role"),
            unescape(F.substring(body, F.instr(body, "[/INST]") + len("[/INST]"), F.length(body))).alias("text"),
        )

    turns = F.filter(F.split("text", "</s>"), lambda x: x != "")
    return examples.select(
        "conv_id", "example", "target_turn",
        F.transform(turns, parsed).alias("turns"),
        unescape(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_length"))).alias("loss_text"),
        F.length("text").cast("long").alias("n_chars"),
    )
