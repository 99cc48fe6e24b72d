"""Preference pairs as one prompt and two masked completions.

Both sides of a pair are conversations: rows of (key, turn, role, text). The longest common prefix of turns (equal role
and text, in turn order) is rendered once as the prompt; what follows on either side is a completion. A mask
of the completion's length has 1 for each character the loss counts (an assistant's words and its end mark) and 0
for the rest. Only built-in array functions are used; a conversation is one row of the result, so it is one array.

Turns of equal number are ordered by role and text. A null role is rendered as an empty one, a null text likewise, but
null and empty are different turns. Rows without a key belong to no conversation and are left out. A pair with one side
only has an empty completion on the other and is not usable; neither is one whose sides are equal. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
HEAD = ("<|", "|>\n")
END = "<|end|>\n"

_NONE = "array<struct<turn:bigint,role:string,text:string>>"


def conversations(rows: DataFrame, key: str, name: str) -> DataFrame:
    """One row per key with its turns in order."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), "role", "text")
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(turn)).alias(name))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD[0]), F.coalesce(turn["role"], F.lit("")), F.lit(HEAD[1]))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def mask(turns: Column) -> Column:
    return F.array_join(
        F.transform(
            turns,
            lambda t: F.concat(
                F.repeat(F.lit("0"), F.length(_head(t))),
                F.repeat(F.when(t["role"] == ASSISTANT, "1").otherwise("0"), F.length(_body(t))),
            ),
        ),
        "",
    )


def format_preferences(chosen: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    """key, prompt, prompt_turns, chosen, chosen_mask, rejected, rejected_mask, usable."""
    pairs = conversations(chosen, key, "_c").join(conversations(rejected, key, "_r"), key, "full")
    pairs = pairs.select(key, *(F.coalesce(c, F.array().cast(_NONE)).alias(c) for c in ("_c", "_r")))
    same = F.zip_with(
        "_c", "_r",
        lambda a, b: a.isNotNull() & b.isNotNull() & a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]),
    )
    pairs = pairs.withColumn("_same", same)
    first = F.array_position("_same", F.lit(False)).cast("int")
    pairs = pairs.withColumn("_common", F.when(first > 0, first - 1).otherwise(F.size("_same")))
    rest = {s: F.slice(s, F.col("_common") + 1, F.greatest(F.size(s) - F.col("_common"), F.lit(0))) for s in ("_c", "_r")}
    pairs = pairs.withColumns({"_prefix": F.slice("_c", 1, "_common"), "_left": rest["_c"], "_right": rest["_r"]})
    answers = lambda side: F.exists(side, lambda t: F.coalesce(t["role"] == ASSISTANT, F.lit(False)))
    return pairs.select(
        key,
        render(F.col("_prefix")).alias("prompt"),
        F.col("_common").alias("prompt_turns"),
        render(F.col("_left")).alias("chosen"),
        mask(F.col("_left")).alias("chosen_mask"),
        render(F.col("_right")).alias("rejected"),
        mask(F.col("_right")).alias("rejected_mask"),
        (answers("_left") & answers("_right")).alias("usable"),
    )
