"""Preference data: chosen and rejected conversations as one prompt with two masked completions.

A pair's conversations are aligned turn by turn; their longest common prefix of turns (equal role
and text) is rendered once, as the prompt, and what follows in each is its completion. A mask
tells which spans of a completion are learned from: the assistant's turns, without their headers.
All of it is DataFrame functions: one aggregation by pair and side, and one by pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a turn is rendered, and the header that asks for the next one.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"
LEARNED_ROLE = "assistant"


def render(turns: Column) -> Column:
    """Turns (role, text) as one string."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))), "")


def _size(t: Column) -> Column:
    return F.char_length(t["role"]) + F.char_length(t["text"]) + len(OPEN + MIDDLE + CLOSE)


def mask(turns: Column) -> Column:
    """Spans (start, end) in code points of the rendered turns that are learned from: text and end mark of the assistant's turns."""
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        end = (state["at"] + _size(t)).cast("long")
        start = (state["at"] + F.char_length(t["role"]) + len(OPEN + MIDDLE)).cast("long")
        learned = F.when(t["role"] == LEARNED_ROLE, F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))
        return F.struct(end.alias("at"), F.concat(state["spans"], learned).alias("spans"))

    return F.aggregate(turns, empty, add, lambda s: s["spans"])


def format_preferences(turns: DataFrame, pair: Column, side: Column, turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(pair_id, complete, n_common, prompt, chosen, chosen_mask, rejected, rejected_mask) for each pair.

    `side` is 'chosen' or 'rejected'; rows with another side or a null pair or turn are left out.
    Null roles and texts count as empty. Turns go by turn number; of rows that share pair, side
    and turn, the smallest (role, text) stands. A pair that lacks a side has `complete` false, no
    common turns, an empty prompt and a null completion on that side. Where one conversation is
    a prefix of the other its completion is empty. An empty table gives an empty table.
    """
    rows = turns.select(pair.alias("pair_id"), side.alias("side"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.where(F.col("pair_id").isNotNull() & F.col("turn").isNotNull() & F.col("side").isin("chosen", "rejected"))
    rows = rows.groupBy("pair_id", "side", "turn").agg(F.min(F.struct("role", "text")).alias("x"))
    one = lambda name: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == name, F.struct("turn", "x")))), lambda t: t["x"])
    pairs = rows.groupBy("pair_id").agg(one("chosen").alias("c"), one("rejected").alias("r"))
    differs = F.filter(F.sequence(F.lit(0), F.least(F.size("c"), F.size("r"))), lambda i: ~F.get("c", i).eqNullSafe(F.get("r", i)) | (i == F.least(F.size("c"), F.size("r"))))
    pairs = pairs.withColumn("n_common", F.array_min(differs)).withColumn("complete", (F.size("c") > 0) & (F.size("r") > 0))
    rest = lambda side: F.slice(side, F.col("n_common") + 1, F.size(side))
    there = lambda side, x: F.when(F.size(side) > 0, x)
    return pairs.select(
        "pair_id",
        "complete",
        F.col("n_common").cast("long").alias("n_common"),
        render(F.slice("c", F.lit(1), F.col("n_common"))).alias("prompt"),
        there("c", render(rest("c"))).alias("chosen"),
        there("c", mask(rest("c"))).alias("chosen_mask"),
        there("r", render(rest("r"))).alias("rejected"),
        there("r", mask(rest("r"))).alias("rejected_mask"),
    )
