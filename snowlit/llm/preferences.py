"""Preference pairs: one prompt, two completions, and what of them is trained.

The longest common turn prefix of a chosen and a rejected conversation ends at the first
turn that one side has and the other lacks, or has with another role or text. It is
found by counting: every distinct (pair, turn, role, text) says on which sides it stands,
and the least turn that stands on one side only is the end. The prefix is rendered once,
as the prompt; the rest of each side is its completion, where only the assistant's words
and their end marks are trained.

A part comes in rows of up to ``BLOCK_TURNS`` turn numbers with the offset of each row, so a
conversation of any length is whole, and never in one row. A usual conversation has a
single row for each part.

Defined cases. Rows that repeat a turn of a side count once. Several different rows of one
turn are ordered by role and text. Null turn: before all others. Null role or text: empty.
Null pair: a pair of its own. Sides that agree in all turns: only a prompt. A side without
turns: the other one is all completion. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snowlit.llm.common import stored

# How a turn is written.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"
BLOCK_TURNS = 256


def prefix_turns(sides: DataFrame) -> DataFrame:
    """``sides`` (pair_id, chosen, turn, role, text) -> one row for each distinct turn with
    in_chosen, in_rejected and ``common``: it lies in the common prefix."""
    turns = sides.select(
        "pair_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), "chosen",
    ).groupBy("pair_id", "turn", "role", "text").agg(
        F.bool_or(F.col("chosen")).alias("in_chosen"), F.bool_or(~F.col("chosen")).alias("in_rejected")
    )
    turns = stored(turns, "preference-turns")
    alone = ~(F.col("in_chosen") & F.col("in_rejected"))
    least = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    ends = turns.filter(alone).groupBy(F.col("pair_id").alias("_pair")).agg(F.min(least).alias("_end"))
    met = turns.join(stored(ends, "prefix-ends"), F.col("pair_id").eqNullSafe(F.col("_pair")), "left")
    return met.select(*turns.columns, (F.col("_end").isNull() | (least < F.col("_end"))).alias("common"))


def format_pairs(sides: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(pair_id, part, block, start, text, trained): ``part`` is prompt, chosen or rejected,
    ``start`` the characters of the part before this row, ``trained`` the spans of ``text``
    that count for the loss."""
    turns = prefix_turns(sides)
    parts = F.when(F.col("common"), F.array(F.lit("prompt"))).otherwise(
        F.filter(
            F.array(F.when(F.col("in_chosen"), F.lit("chosen")), F.when(F.col("in_rejected"), F.lit("rejected"))),
            lambda p: p.isNotNull(),
        )
    )
    piece = F.concat(F.lit(OPEN), "role", F.lit(MIDDLE), "text", F.lit(CLOSE))
    block = F.coalesce(F.expr(f"CAST(floor(turn / {int(block_turns)}) AS BIGINT)"), F.lit(-(2**62)))
    rows = turns.select("pair_id", F.explode(parts).alias("part"), block.alias("block"), "turn", "role", "text", piece.alias("piece"))
    entry = F.struct(F.col("turn").isNotNull().alias("given"), "turn", "role", "text", "piece")
    joined = rows.groupBy("pair_id", "part", "block").agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    head = F.length(F.lit(OPEN)) + F.length(F.lit(MIDDLE))
    steps = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["piece"])).alias("at"),
            F.when(
                t["role"] == "assistant",
                F.concat(acc["spans"], F.array(F.struct(
                    (acc["at"] + head + F.length(t["role"])).alias("start"), (acc["at"] + F.length(t["piece"]) - 1).alias("end")
                ))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    none = F.array().cast("array<struct<start: int, end: int>>")
    written = joined.select(
        "pair_id", "part", "block", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("text"),
        F.when(F.col("part") == "prompt", none).otherwise(steps["spans"]).alias("trained"),
    )
    before = Window.partitionBy("pair_id", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text").cast("bigint")).over(before), F.lit(0))
    return written.select("pair_id", "part", "block", start.alias("start"), "text", "trained")


def sides_of(conversations: DataFrame, conv_id="conv_id") -> DataFrame:
    """Preference sides from plain conversations: chosen is the conversation, rejected ends
    with its first assistant reply in place of its last one."""
    turns = conversations.select(F.col(conv_id).alias("pair_id"), "turn", "role", "text")
    spoken = F.struct("turn", "text")
    replies = turns.filter(F.col("role") == "assistant").groupBy("pair_id").agg(
        F.min(spoken)["text"].alias("first_reply"), F.max("turn").alias("last_turn")
    ).withColumnRenamed("pair_id", "_pair")
    met = turns.join(stored(replies, "replies"), F.col("pair_id").eqNullSafe(F.col("_pair")), "left")
    replaced = F.when((F.col("role") == "assistant") & (F.col("turn") == F.col("last_turn")), F.col("first_reply")).otherwise(F.col("text"))
    side = F.explode(F.array(F.struct(F.lit(True).alias("chosen"), F.col("text")), F.struct(F.lit(False).alias("chosen"), replaced.alias("text"))))
    return met.select("pair_id", "turn", "role", side.alias("s")).select("pair_id", "turn", "role", "s.chosen", "s.text")
