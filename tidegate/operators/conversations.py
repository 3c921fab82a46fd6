"""Conversation logs: termination, truncation and outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# --- fixed values: markers and the round cap -----------------------------------------
TERMINATION_MARKER = "TERMINATE"
REVIEW_MARKER = "SECURITY REVIEW PASSED"
APPROVAL_MARKER = "CODE APPROVED"
MAX_ROUNDS = 20
# --- end of fixed values -------------------------------------------------------------


def is_termination(text: Column, marker: str = TERMINATION_MARKER) -> Column:
    """Whether a message holds the marker, case-sensitive; null text counts as empty."""
    return F.contains(F.coalesce(text, F.lit("")), F.lit(marker))


def truncate_conversations(
    turns: DataFrame, marker: str = TERMINATION_MARKER, max_rounds: int = MAX_ROUNDS
) -> DataFrame:
    """Turns up to and including the first marked one, ``max_rounds`` at most.

    The cap comes first: each task keeps the first ``max_rounds`` turns of a
    conversation, so the window that follows holds that many rows and no more.
    """
    in_order = Window.partitionBy("conv_id").orderBy("turn")
    marked = F.when(is_termination(F.col("text"), marker), F.col("turn"))
    capped = (turns.withColumn("_round", F.row_number().over(in_order))
              .filter(F.col("_round") <= max_rounds))
    return (capped.withColumn("_end", F.min(marked).over(Window.partitionBy("conv_id")))
            .filter(F.col("_end").isNull() | (F.col("turn") <= F.col("_end")))
            .select(*turns.columns))


def conversation_outcome(
    turns: DataFrame, marker: str = TERMINATION_MARKER, max_rounds: int = MAX_ROUNDS
) -> DataFrame:
    """Per conversation: first turn of each marker, turns in all and used, capped or not.

    ``capped`` says that the round cap cut the conversation off, not the marker. One scan
    and one shuffle: turns are numbered once, and all the rest is one aggregate over
    rounds on the same partitioning.
    """
    def first(m: str, what: str) -> Column:
        return F.min(F.when(is_termination(F.col("text"), m), F.col(what)))

    numbered = turns.select("conv_id", "turn", "text", F.row_number().over(
        Window.partitionBy("conv_id").orderBy("turn")).alias("_round"))
    totals = numbered.groupBy("conv_id").agg(
        first(marker, "turn").alias("terminated_turn"),
        first(REVIEW_MARKER, "turn").alias("review_passed_turn"),
        first(APPROVAL_MARKER, "turn").alias("approved_turn"),
        F.count("*").alias("n_turns"),
        first(marker, "_round").alias("_end"))
    used = F.least("n_turns", F.lit(max_rounds), "_end").cast("bigint")  # least skips a null end
    ended = F.coalesce(F.col("_end") <= max_rounds, F.lit(False))
    return totals.select(
        "conv_id", "terminated_turn", "review_passed_turn", "approved_turn", "n_turns",
        used.alias("turns_used"), (~ended & (F.col("n_turns") > used)).alias("capped"))
