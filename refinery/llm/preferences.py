"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns becomes the prompt, rendered once; what follows it on
either side becomes a completion with the character spans that count for training: the
answers, not the other turns nor the marks around them. DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import column_named

OPEN, SHUT, END = "<|", "|>\n", "<|end|>\n"


def _sides(turns: DataFrame, key: str, turn: str, role: str, text: str, name: str) -> DataFrame:
    """One row per conversation with its turns in order."""
    one = F.struct(
        column_named(turns, turn).alias("turn"),
        F.coalesce(column_named(turns, role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(column_named(turns, text).cast("string"), F.lit("")).alias("text"),
    )
    rows = turns.select(column_named(turns, key).alias("key"), one.alias("one")).where("key is not null")
    return rows.groupBy("key").agg(F.transform(F.array_sort(F.collect_list("one")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias(name))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(SHUT))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END))), "")


def _spans(turns: Column, trained: str) -> Column:
    """Character spans (start, end) of the texts and end marks of the trained role."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(_head(t))
        end = begin + F.length(t["text"]) + len(END)
        more = F.when(t["role"] == trained, F.array(F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end")))).otherwise(
            F.array().cast("array<struct<start:bigint,end:bigint>>")
        )
        return F.struct(end.cast("long").alias("at"), F.concat(state["spans"], more).alias("spans"))

    return F.aggregate(turns, start, step, lambda s: s["spans"])


def format_preferences(
    chosen: DataFrame,
    rejected: DataFrame,
    key: str = "pair_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained: str = "assistant",
    keep_unanswered: bool = False,
) -> DataFrame:
    """One row per pair: the key, ``n_prompt_turns``, ``prompt``, ``chosen``, ``rejected`` and
    their ``chosen_spans``, ``rejected_spans`` (arrays of (start, end), in characters).

    ``chosen`` and ``rejected`` hold a row per turn. Turns are ordered by ``turn`` (null first),
    ties by role and text; repeated rows are turns of their own. Null roles and texts are
    empty. Turns with a null key are left out, and so are keys that only one side has; with
    ``keep_unanswered`` a key that only ``chosen`` has gets an empty prompt and an empty rejected
    completion, for rejected sides that consist of no turn. Pairs that do not differ have empty completions. Empty tables give no rows, other columns are
    ignored. A conversation is one row here, as it is in the result.
    """
    pairs = _sides(chosen, key, turn, role, text, "c").join(_sides(rejected, key, turn, role, text, "r"), "key", "left" if keep_unanswered else "inner")
    pairs = pairs.withColumn("r", F.coalesce("r", F.slice("c", F.lit(1), F.lit(0))))
    shorter = F.least(F.size("c"), F.size("r"))
    positions = F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>"))
    same = F.aggregate(positions, F.lit(0), lambda n, i: F.when((n == i) & (F.get("c", i) == F.get("r", i)), n + 1).otherwise(n))
    cut = pairs.withColumn("n", same).select(
        "key",
        "n",
        F.slice("c", F.lit(1), F.col("n")).alias("p"),
        F.slice("c", F.col("n") + 1, F.size("c")).alias("c"),
        F.slice("r", F.col("n") + 1, F.size("r")).alias("r"),
    )
    return cut.select(
        F.col("key").alias(key),
        F.col("n").cast("long").alias("n_prompt_turns"),
        _render(F.col("p")).alias("prompt"),
        _render(F.col("c")).alias("chosen"),
        _render(F.col("r")).alias("rejected"),
        _spans(F.col("c"), trained).alias("chosen_spans"),
        _spans(F.col("r"), trained).alias("rejected_spans"),
    )


def swapped_answers(conversations: DataFrame, answers: str = "assistant") -> tuple[DataFrame, DataFrame]:
    """Pairs from plain conversations: each one up to its last answer is chosen, the same with
    the last answer of its neighbour (ids 2k and 2k + 1) is rejected.

    Ids are whole numbers, and the columns are named as in ``conversations``. Conversations
    without an answer give none; without an answer of the neighbour the
    rejected side ends before the answer. Ties of the last turn go to the greatest text.
    """
    turns = conversations.select(
        F.col("conv_id").alias("pair_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).where("pair_id is not null and turn is not null")
    last = turns.where(F.col("role") == answers).groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("l"))
    last = last.select("pair_id", F.col("l.turn").alias("last_turn"), F.col("l.text").alias("answer"))
    upto = turns.join(last.select("pair_id", "last_turn"), "pair_id").where("turn <= last_turn")
    chosen = upto.drop("last_turn")
    neighbour = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), "answer")
    swapped = last.select("pair_id", F.col("last_turn").alias("turn")).join(neighbour, "pair_id").select(
        "pair_id", "turn", F.lit(answers).alias("role"), F.col("answer").alias("text")
    )
    rejected = upto.where("turn < last_turn").drop("last_turn").union(swapped)
    # The rejected side may have no turn at all; the pair is that of the chosen side.
    return chosen, rejected
