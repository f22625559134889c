"""Preference pairs of chat conversations: one prompt, two masked completions.

The turns of a pair's chosen and rejected side are put in order; the longest prefix of
turns alike in role and text is rendered once as the prompt, what follows on each side
is its completion. Masks give, as character ranges of a completion, what is trained on:
the texts of the trained roles with their end marker.

Only built-in functions. A pair is one output row, so its turns meet in one task, as a
document's words do; nothing else is gathered.

Defined cases: turns are ordered by (turn, role, text), so ties and repeated rows keep
a fixed order; a null role is ``unknown``, a null text is empty, a null turn comes
first; rows with a null pair id form one pair; a side without turns has an empty
completion; markers in texts are broken by a blank, so texts cannot fake a turn;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def head(m: Column) -> Column:
    return F.concat(F.lit(OPEN), m["role"], F.lit(CLOSE))


def body(m: Column) -> Column:
    return F.concat(F.replace(m["text"], F.lit(OPEN), F.lit("< |")), F.lit(END))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda m: F.concat(head(m), body(m))), "")


def mask(turns: Column, trained: Sequence[str]) -> Column:
    """``start:end`` of each trained text in rendered(turns), joined by commas."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc, m):
        begin = acc["at"] + F.length(head(m))
        end = begin + F.length(body(m))
        span = F.array(F.concat_ws(":", begin.cast("string"), end.cast("string")))
        spans = F.when(m["role"].isin(*trained), F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: F.array_join(acc["spans"], ","))


def preference_pairs(turns: DataFrame, trained: Sequence[str] = ("assistant",)) -> DataFrame:
    """``turns``: pair_id, side (chosen or rejected), turn, role, text. One row a pair:
    pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask."""
    message = F.struct(
        "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    sides = turns.groupBy("pair_id").agg(
        *(F.array_sort(F.collect_list(F.when(F.col("side") == s, message))).alias(s) for s in ("chosen", "rejected"))
    )
    alike = F.zip_with(
        "chosen", "rejected", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False))
    )
    first_other = F.array_position(alike, False)
    n = F.when(first_other > 0, first_other - 1).otherwise(F.size(alike)).cast("int")
    sides = sides.withColumn("n", n)
    rest = {s: F.slice(F.col(s), F.col("n") + 1, F.greatest(F.size(s) - F.col("n"), F.lit(0))) for s in ("chosen", "rejected")}
    return sides.select(
        "pair_id",
        F.col("n").cast("long").alias("n_prompt_turns"),
        rendered(F.slice("chosen", F.lit(1), F.col("n"))).alias("prompt"),
        *(rendered(rest[s]).alias(s) for s in rest),
        *(mask(rest[s], trained).alias(f"{s}_mask") for s in rest),
    )


def cut_reply_pairs(conversations: DataFrame) -> DataFrame:
    """Turns of pairs made from single conversations: chosen as they are, rejected with
    the last reply of the assistant cut to the first half of its characters."""
    reply = F.col("role") == "assistant"
    turns = conversations.select("conv_id", "turn", "role", "text")
    last = turns.groupBy(F.col("conv_id").alias("of")).agg(F.max(F.when(reply, F.col("turn"))).alias("last_reply"))
    rows = turns.join(last, F.col("conv_id").eqNullSafe(F.col("of"))).withColumn("side", F.explode(F.array(F.lit("chosen"), F.lit("rejected"))))
    is_cut = reply & (F.col("side") == "rejected") & (F.col("turn") == F.col("last_reply"))
    half = F.expr("substring(text, 1, int(length(text) / 2))")
    return rows.select(
        F.col("conv_id").alias("pair_id"), "side", "turn", "role", F.when(is_cut, half).otherwise(F.col("text")).alias("text")
    )
