"""Operator 2: preference formatting of chat conversations.

A preference pair is a chosen and a rejected conversation.  Their longest common prefix of
turns (same role and text) is rendered once as the prompt; the rest of either side is its
completion, with the character spans that training may learn from: the assistant's turns,
end mark included.

Defined cases: turns are ordered by turn, then role and text; null roles and texts render as
empty; two nulls are equal; identical conversations give empty completions; a pair with one
side only has an empty prompt and an empty completion on the other side; repeated turns stay;
a null pair id is a pair of its own.  A pair's row holds its whole conversation, as it has to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The marks of the template.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def _empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _empty(turn["role"]), F.lit(CLOSE), _empty(turn["text"]), F.lit(END))


def _join(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def _spans(turns: Column, learned: str) -> Column:
    """Character spans (start, stop) of the learned role's text and end mark in the rendering."""
    none = F.array().cast("array<struct<start:int,stop:int>>")
    state = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def add(acc: Column, turn: Column) -> Column:
        start = acc["at"] + F.length(_empty(turn["role"])) + F.lit(len(OPEN) + len(CLOSE))
        stop = start + F.length(_empty(turn["text"])) + F.lit(len(END))
        own = F.when(turn["role"] == learned, F.array(F.struct(start.alias("start"), stop.alias("stop")))).otherwise(none)
        return F.struct(stop.alias("at"), F.concat(acc["spans"], own).alias("spans"))

    return F.aggregate(turns, state, add)["spans"]


def exchanged(turns: DataFrame, id_column: str = "conv_id", learned: str = "assistant") -> DataFrame:
    """Pairs (pair_id, c, r) that share all but one answer, from rows (id, turn, role, text).

    Chosen (c) is each conversation; rejected (r) the same with its last answer of ``learned`` (by
    turn, then text; repeated rows alike) exchanged for that of its neighbour, whose id differs in
    the last bit.  Without such a neighbour the answer is empty; a conversation without answer, or
    whose neighbour gave the same, has two equal sides.  A null id has no neighbour.
    """
    pairs = turns.groupBy(F.col(id_column).cast("long").alias("pair_id")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("c"))
    answers = F.filter("c", lambda x: x["role"] == learned)
    pairs = pairs.withColumn("last", F.get(answers, F.size(answers) - 1))
    other = pairs.where("last is not null").select(
        (F.col("pair_id") + 1 - 2 * F.pmod("pair_id", F.lit(2))).alias("id"), F.coalesce("last.text", F.lit("")).alias("other"))
    both = pairs.join(other, F.col("pair_id") == F.col("id"), "left")
    instead = F.transform("c", lambda x: F.when(F.col("last").isNotNull() & x.eqNullSafe(F.col("last")), F.struct(
        x["turn"].alias("turn"), x["role"].alias("role"), F.coalesce("other", F.lit("")).alias("text"))).otherwise(x))
    return both.select("pair_id", "c", F.array_sort(instead).alias("r"))


def preference_pairs(turns: DataFrame, learned: str = "assistant") -> DataFrame:
    """One row per pair from rows (pair_id, chosen boolean, turn, role, text).

    Columns: pair_id, prompt_turns, prompt, and per side completion, spans and turns.
    """
    turn = F.struct("turn", "role", "text")
    side = lambda flag: F.array_sort(F.collect_list(F.when(F.col("chosen") == flag, turn)))
    return formatted(turns.groupBy("pair_id").agg(side(True).alias("c"), side(False).alias("r")), learned)


def formatted(pairs: DataFrame, learned: str = "assistant") -> DataFrame:
    """The rows of :func:`preference_pairs` from pairs (pair_id, c, r) with their ordered turns."""
    c, r = F.col("c"), F.col("r")
    both = F.least(F.size(c), F.size(r))
    differs = lambda i: ~(c[i]["role"].eqNullSafe(r[i]["role"]) & c[i]["text"].eqNullSafe(r[i]["text"]))
    places = F.when(both > 0, F.sequence(F.lit(0), both - 1)).otherwise(F.array().cast("array<int>"))
    pairs = pairs.withColumn("p", F.coalesce(F.get(F.filter(places, differs), F.lit(0)), both))
    rest = lambda x: F.slice(x, F.col("p") + 1, F.greatest(F.size(x) - F.col("p"), F.lit(0)))
    return pairs.select(
        "pair_id", F.col("p").alias("prompt_turns"), _join(F.slice(c, F.lit(1), F.col("p"))).alias("prompt"),
        *[x for name, t in (("chosen", c), ("rejected", r)) for x in (
            _join(rest(t)).alias(name), _spans(rest(t), learned).alias(f"{name}_spans"),
            F.size(rest(t)).alias(f"{name}_turns"))])
