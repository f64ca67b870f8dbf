"""Relational chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted; adjacent turns of
one role are merged into one block by array aggregation; blocks are joined to
one string.  A block is ``<|im_start|>role\\n``, its texts with ``<|turn|>``
between, then ``<|im_end|>\\n``.  Inside roles and texts an ampersand becomes
``&amp;`` and the first sign of every control string becomes an entity, so no
control string is left and the original comes back exactly.  The loss mask is
the spans (1-based start, length in characters) of the trained role's texts.

Defined cases: a null text or role is empty; a null turn sorts first; turns
with equal numbers sort by role, then text; repeated rows are turns of their
own; a null conv_id is a conversation; an empty table gives no conversations;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, STOP, NEXT = "<|im_start|>", "<|im_end|>", "<|turn|>"
#: Starts of control strings of common templates; the first sign of each is escaped.
CONTROLS = ("<|", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
ENTITIES = {"<": "&lt;", "[": "&#91;"}


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(ENTITIES[control[0]] + control[1:]))
    return out


def unescape(text: Column) -> Column:
    for sign, entity in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def format_conversations(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """(conv_id, turn, role, text) to conv_id, formatted, loss_spans array<struct<start,length>>."""
    clean = turns.select(
        "conv_id",
        F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"),
    )
    sorted_ = clean.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    said = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), escape(t["text"]).alias("text")))
    # a turn opens a block where the role before it is another
    blocks = sorted_.select("conv_id", said.alias("said"))
    opens = F.transform("said", lambda t, i: F.struct(t["role"].alias("role"), t["text"].alias("text"), ((i == 0) | (F.try_element_at("said", i)["role"] != t["role"])).alias("opens")))
    blocks = blocks.select("conv_id", opens.alias("said"))

    def lead(t: Column, i: Column) -> Column:
        """What stands before a turn's text."""
        fresh = F.concat(F.when(i == 0, F.lit("")).otherwise(F.lit(STOP + "\n")), F.lit(START), _escape_role(t["role"]), F.lit("\n"))
        return F.when(t["opens"], fresh).otherwise(F.lit(NEXT))

    pieces = F.transform("said", lambda t, i: F.struct(t["role"].alias("role"), lead(t, i).alias("lead"), t["text"].alias("text")))
    blocks = blocks.select("conv_id", pieces.alias("p"))
    text = F.concat(F.array_join(F.transform("p", lambda x: F.concat(x["lead"], x["text"])), ""), F.lit(STOP + "\n"))
    kind = "array<struct<start:int,length:int>>"
    walk = F.aggregate(
        "p",
        F.struct(F.lit(1).alias("at"), F.array().cast(kind).alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["lead"]) + F.length(x["text"])).alias("at"),
            F.when(x["role"] == trained, F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.length(x["lead"])).alias("start"), F.length(x["text"]).alias("length"))).cast(kind))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return blocks.select("conv_id", text.alias("formatted"), walk.alias("loss_spans"))


def parse_formatted(formatted: DataFrame) -> DataFrame:
    """Read turns and loss text back: conv_id, turns array<struct<role,text>>, loss_text, formatted."""
    # the first piece is empty: nothing stands before the first block
    blocks = F.slice(F.split(F.col("formatted"), r"<\|im_start\|>"), 2, 1 << 30)

    def texts(block: Column) -> Column:
        head = F.instr(block, "\n")
        return F.split(block.substr(head + F.lit(1), F.length(block) - head - F.lit(len(STOP) + 1)), r"<\|turn\|>")

    def read(block: Column) -> Column:
        role = _unescape_role(F.substring_index(block, "\n", 1))
        return F.transform(texts(block), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    turns = F.flatten(F.transform(blocks, read))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"], s["length"]))), "")
    return formatted.select("conv_id", turns.alias("turns"), loss.alias("loss_text"), "formatted")
