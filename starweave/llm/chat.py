"""Preference formatting of chosen and rejected conversations.

``format_turns`` finds the longest common turn prefix of two conversations
(turns equal in role and text, from the first), renders it once as the prompt,
and emits the two completions with their masks: spans in code points of the
completion, of which those of assistant turns are trained on.
``format_pairs`` does so for a table of (chosen_id, rejected_id).

A turn is rendered as ``<|role|>\\ntext\\n``.  A conversation is its turns by
turn number (ties by role, then text).  Only built-in functions are used; the
turns are gathered per conversation, never per group of conversations.

``contrasts`` makes pairs where a table of conversations has none.  All
conversations are sorted by their opening (a hash of the first turn) and
conv_id, and each is the chosen one against the next: if both have the same
opening, the next conversation itself is rejected; else the rejected side is
the chosen one with its last assistant turn replaced by the next one's (the
whole next conversation if either has no assistant turn).  The order comes
from a range partition over (opening, conv_id), so an opening that a third of
all conversations share is spread over many partitions, and no two
conversations meet but neighbours.

Output: chosen_id, rejected_id, n_common (turns), prompt, chosen, rejected,
chosen_mask and rejected_mask (array of start, length, train).

Null role or text counts as empty.  A pair whose conversations are equal has
two empty completions and empty masks.  A side without turns has an empty
completion (and the prompt is empty); pairs with a null id on a side, too.
Repeated turns are all kept, repeated pairs each give a row.  Turns without
conv_id are left out.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import surrogate_key
from .common import take, written


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order."""
    turns = take(turns, "conv_id", "turn", "role", "text").where(F.col("conv_id").isNotNull()) \
        .select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text"))
    gathered = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return turns.groupBy("conv_id").agg(gathered.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(
            t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def contrasts(turns: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, a, b): every conversation but the last in
    order, against the next or a mismatched answer; see the module's text."""
    whole = written(conversations(turns), "conversations")
    first = F.col("turns")[0]
    opening = F.md5(F.concat_ws("|", first["role"], first["text"]))
    numbered = surrogate_key(whole.select(opening.alias("opening"), "conv_id"), "place",
                             ["opening", "conv_id"])
    placed = numbered.join(whole, "conv_id")
    other = placed.select((F.col("place") - 1).alias("place"), F.col("opening").alias("opening_b"),
                          F.col("conv_id").alias("rejected_id"), F.col("turns").alias("other"))
    both = placed.withColumnRenamed("conv_id", "chosen_id").join(other, "place")
    answer = F.try_element_at(F.filter("other", lambda t: t["role"] == "assistant"), F.lit(-1))
    at = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i)))
    swapped = F.transform("turns", lambda t, i: F.when(i == F.col("at"), F.col("answer"))
                          .otherwise(t))
    whole_b = (F.col("opening") == F.col("opening_b")) | F.col("at").isNull() | F.col("answer").isNull()
    return both.withColumn("answer", answer).withColumn("at", at).select(
        "chosen_id", "rejected_id", F.col("turns").alias("a"),
        F.when(whole_b, F.col("other")).otherwise(swapped).alias("b"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("\n"))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _mask(turns: Column) -> Column:
    """A span for each turn, by a running sum of lengths."""
    def step(spans: Column, turn: Column) -> Column:
        last = F.try_element_at(spans, F.lit(-1))
        start = F.coalesce(last["start"] + last["length"], F.lit(0))
        span = F.struct(start.alias("start"), F.char_length(_rendered(turn)).alias("length"),
                        (turn["role"] == "assistant").alias("train"))
        return F.concat(spans, F.array(span))

    empty = F.expr("cast(array() as array<struct<start:int,length:int,train:boolean>>)")
    return F.aggregate(turns, empty, step)


def format_turns(pairs: DataFrame) -> DataFrame:
    """One row per pair of turn lists ``a`` (chosen) and ``b`` (rejected)."""
    short = F.least(F.size("a"), F.size("b"))
    equal = F.zip_with("a", "b", lambda x, y: x.eqNullSafe(y))
    differs = F.array_position(F.slice(equal, 1, short), False)
    common = F.when(short == 0, 0).when(differs > 0, differs - 1).otherwise(short).cast("int")
    cut = pairs.withColumn("n_common", common)

    def rest(side: str) -> Column:
        return F.slice(side, F.col("n_common") + 1, F.size(side)).alias(side)

    cut = cut.select("chosen_id", "rejected_id", "n_common",
                     F.slice("a", 1, F.col("n_common")).alias("c"), rest("a"), rest("b"))
    return cut.select(
        "chosen_id", "rejected_id", F.col("n_common").cast("long").alias("n_common"),
        _text(F.col("c")).alias("prompt"), _text(F.col("a")).alias("chosen"),
        _text(F.col("b")).alias("rejected"), _mask(F.col("a")).alias("chosen_mask"),
        _mask(F.col("b")).alias("rejected_mask"))


def format_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per (chosen_id, rejected_id) of ``pairs``; see the module's text."""
    whole = written(conversations(turns), "conversations")
    none = F.expr("cast(array() as array<struct<role:string,text:string>>)")
    return format_turns(
        take(pairs, "chosen_id", "rejected_id")
        .join(whole.toDF("chosen_id", "a"), "chosen_id", "left")
        .join(whole.toDF("rejected_id", "b"), "rejected_id", "left")
        .select("chosen_id", "rejected_id", F.coalesce("a", none).alias("a"),
                F.coalesce("b", none).alias("b")))
