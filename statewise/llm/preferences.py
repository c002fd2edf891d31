"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns is rendered once, as the prompt; what
follows in either conversation is its completion, with the character ranges a
model should learn from. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The marks of the chat template.
OPENING, CLOSING = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns numbered from 1 in order of ``turn``; identical rows count once."""
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where(F.col("conv_id").isNotNull()).distinct()
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    return turns.select("conv_id", F.row_number().over(order).alias("at"), "role", "text")


def _rendered(side: str):
    header = F.concat(F.lit(OPENING), F.col(f"{side}.role"), F.lit("\n"))
    whole = F.concat(header, F.col(f"{side}.text"), F.lit(CLOSING))
    return F.struct(
        F.col("at"),
        whole.alias("whole"),
        F.length(header).alias("header"),
        (F.col(f"{side}.role") == LEARNED).alias("learned"),
    )


def _completion(turns: str):
    return F.array_join(F.transform(turns, lambda turn: turn["whole"]), "")


def _mask(turns: str):
    """Ranges [from, below) of the learned characters of a completion."""
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<from:int,below:int>>").alias("spans")
    )

    def step(state, turn):
        below = state["at"] + F.length(turn["whole"])
        span = F.struct((state["at"] + turn["header"]).alias("from"), below.alias("below"))
        spans = F.when(turn["learned"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(below.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per ``conv_id`` found in both: ``conv_id, n_prompt_turns, prompt,
    chosen, rejected, chosen_mask, rejected_mask``.

    Both frames have ``conv_id, turn, role, text``. A mask lists the ranges of
    characters of its completion that belong to assistant turns, without the
    turn's header and with its closing mark. Where the conversations are equal,
    or one is a prefix of the other, a completion is ''. NULL roles and texts
    count as ''; rows without ``conv_id`` and conversations on one side only
    give no row; rows repeated whole count once, turns with the same number are
    taken in order of role and text. A conversation's turns are sorted and
    joined by Spark; only its rendered row, the result, is put together.
    """
    joined = (
        _turns(chosen)
        .select("conv_id", "at", F.struct("role", "text").alias("c"))
        .join(
            _turns(rejected).select("conv_id", "at", F.struct("role", "text").alias("r")),
            ["conv_id", "at"],
            "full_outer",
        )
    )
    same = F.col("c").eqNullSafe(F.col("r"))
    until = W.partitionBy("conv_id").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    marked = joined.withColumn("common", F.min(same).over(until))

    def gathered(side: str, common: bool):
        wanted = F.col(side).isNotNull() & (F.col("common") == F.lit(common))
        return F.array_sort(F.collect_list(F.when(wanted, _rendered(side))))

    return (
        marked.groupBy("conv_id")
        .agg(
            F.max(F.col("c").isNotNull()).alias("in_chosen"),
            F.max(F.col("r").isNotNull()).alias("in_rejected"),
            gathered("c", True).alias("prefix"),
            gathered("c", False).alias("c_rest"),
            gathered("r", False).alias("r_rest"),
        )
        .where("in_chosen and in_rejected")
        .select(
            "conv_id",
            F.size("prefix").cast("bigint").alias("n_prompt_turns"),
            _completion("prefix").alias("prompt"),
            _completion("c_rest").alias("chosen"),
            _completion("r_rest").alias("rejected"),
            _mask("c_rest").alias("chosen_mask"),
            _mask("r_rest").alias("rejected_mask"),
        )
    )


def with_other_answers(conversations: DataFrame) -> DataFrame:
    """A rejected twin of every conversation: its last assistant turn has the
    text of its neighbour's (ids 2n and 2n + 1 are neighbours; '' without one).

    Conversations without an assistant turn are their own twins.
    """
    answers = (
        conversations.where(F.col("role") == LEARNED)
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", "text")).alias("last"))
    )
    other = answers.select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("last.text").alias("_other")
    )
    last = answers.select("conv_id", F.col("last.turn").alias("_turn")).join(other, "conv_id", "left")
    replaced = (F.col("turn") == F.col("_turn")) & (F.col("role") == LEARNED)
    return conversations.join(last, "conv_id", "left").select(
        "conv_id",
        "turn",
        "role",
        F.when(replaced, F.coalesce("_other", F.lit(""))).otherwise(F.col("text")).alias("text"),
    )


def mask_text(name: str):
    """A mask as text, ``from:below`` joined by commas."""
    return F.array_join(
        F.transform(name, lambda span: F.concat_ws(":", span["from"].cast("string"), span["below"].cast("string"))),
        ",",
    ).alias(name)
