"""Preference pairs of conversations as one prompt and two masked completions, in native column expressions only.

Two conversations of a pair agree in their first turns; the longest common prefix of turns is rendered once as the
prompt, what follows it in either conversation is that conversation's completion. A completion comes with
the character ranges that count for the loss: the assistant's texts and their end marks, never a prompt, a
header or another speaker.

The prefix is found without bringing a conversation together: per pair and turn, both sides' rows are reduced to
their smallest and largest (role, text) and a count; the first turn where these tell a difference, a minimum per
pair, ends the prefix. Only then is each pair put in order as the one record it becomes.

``pairs_by_first_turn`` pairs each conversation with the smallest one that has the same first turn, so a first turn
that thousands share gives as many pairs, not their square.

Defined cases: rows without conv_id or turn are dropped. Of several rows of a turn the largest (role, text) counts, a
missing text is empty and a missing role is ``user``. Turn numbers may begin anywhere and leave gaps; a number that only one side has ends
the prefix. Equal conversations give a prompt and two empty completions with ``tied`` set. Pairs that name an unknown
conversation find no turns there. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orewright.llm.base import stored

BEGIN, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


def clean_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with one row for each turn."""
    rows = conversations.filter("conv_id is not null and turn is not null").select(
        "conv_id", "turn",
        F.struct(F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("said"),
    )
    return rows.groupBy("conv_id", "turn").agg(F.max("said").alias("said")).select("conv_id", "turn", "said.role", "said.text")


def pairs_by_first_turn(turns: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id): every conversation with the smallest one of the same first turn."""
    first = turns.groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text")).alias("f")).select("conv_id", "f.role", "f.text")
    hubs = first.groupBy("role", "text").agg(F.min("conv_id").alias("chosen_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return first.join(hubs, ["role", "text"]).filter("conv_id <> chosen_id").select("chosen_id", F.col("conv_id").alias("rejected_id"))


def _rendered(parts: Column) -> Column:
    text = F.transform(parts, lambda p: F.concat(F.lit(BEGIN), p["role"], F.lit("\n"), p["text"], F.lit(END + "\n")))
    return F.array_join(text, "")


def _mask(parts: Column) -> Column:
    """start:stop of what counts for the loss, joined by commas; code points, ends exclusive."""
    frame = len(BEGIN) + 1

    def add(done: Column, p: Column) -> Column:
        start = done["at"] + frame + F.length(p["role"])
        stop = start + F.length(p["text"]) + len(END)
        span = F.concat_ws(":", start.cast("string"), stop.cast("string"))
        spans = F.when(p["role"] == LEARNED_ROLE, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct((stop + 1).alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.array_join(F.aggregate(parts, start, add)["spans"], ",")


def preference_examples(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """chosen_id, rejected_id, n_prompt_turns, tied, prompt, chosen, chosen_mask, rejected, rejected_mask."""
    turns = stored(turns, "turns")
    pairs = stored(pairs.select("chosen_id", "rejected_id").distinct(), "pairs")
    key = ["chosen_id", "rejected_id"]
    sides = [
        turns.join(pairs.withColumnRenamed(f"{side}_id", "conv_id"), "conv_id").withColumnRenamed("conv_id", f"{side}_id").select(
            *key, F.lit(number).alias("side"), "turn", "role", "text"
        )
        for number, side in ((1, "chosen"), (2, "rejected"))
    ]
    rows = sides[0].unionAll(sides[1])
    said = F.struct("role", "text")
    met = rows.groupBy(*key, "turn").agg(F.count("*").alias("n"), F.min(said).alias("low"), F.max(said).alias("high"))
    cut = met.groupBy(*key).agg(F.min(F.when((F.col("n") < 2) | (F.col("low") != F.col("high")), F.col("turn"))).alias("cut"))
    placed = rows.join(cut, key).withColumn("shared", F.col("cut").isNull() | (F.col("turn") < F.col("cut")))
    placed = placed.filter("not shared or side = 1").withColumn("part", F.when(F.col("shared"), 0).otherwise(F.col("side")))
    one = placed.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("part", "turn", "role", "text"))).alias("all"), F.first("cut").alias("cut")
    )

    def part(number: int) -> Column:
        return F.filter("all", lambda p: p["part"] == number)

    return one.select(
        *key, F.size(part(0)).cast("long").alias("n_prompt_turns"), F.col("cut").isNull().alias("tied"),
        _rendered(part(0)).alias("prompt"),
        _rendered(part(1)).alias("chosen"), _mask(part(1)).alias("chosen_mask"),
        _rendered(part(2)).alias("rejected"), _mask(part(2)).alias("rejected_mask"),
    )
