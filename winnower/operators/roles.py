"""Order of roles in conversations, by summaries of runs of turns that can be merged.

A run of turns is summed up by its length, its first and last role and its first
fault. Two neighbouring runs merge from their summaries alone: a fault where they
meet can only concern the last role of the one and the first role of the other. So
turns are sorted by range over all tasks, each task sums up the runs it holds, and
a conversation of any length is split like any other data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnower.storage import written

ASKING, ANSWERING, SETTING = "user", "assistant", "system"
_ROLES = (ASKING, ANSWERING, SETTING)


def turn_fault(role: Column, before: Column, first: Column) -> Column:
    """What is wrong with a turn after the one before it, or NULL.

    ``first`` says whether the turn begins its conversation, ``before`` is the
    role ahead of it. A role that is none of the known ones is only a fault of
    its own turn.
    """
    opening = first | (before == SETTING)
    return (
        F.when(role.isNull() | ~role.isin(*_ROLES), "unknown_role")
        .when((role == SETTING) & ~first, "late_system")
        .when(opening & (role == ANSWERING), "answer_first")
        .when(~first & (role == before), "repeated_role")
    )


def role_check(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role"
) -> DataFrame:
    """(conv_id, n_turns, first_role, last_role, fault, fault_at), one row for each conversation.

    ``fault`` is the first fault in order of turns, ``open_end`` if nothing else
    is wrong but the last turn is no answer, NULL if nothing is; ``fault_at``
    counts turns from 0. Turns of equal number follow their role, nulls first.
    """
    order = ["conv", "turn", "role"]
    rows = turns.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role")
    )
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id counts the rows of a task in their order; its upper bits name the task.
    ordered = ordered.withColumn("place", F.monotonically_increasing_id())
    ordered = written(turns.sparkSession, ordered.select("conv", "role", "place"), "turns")
    piece = F.shiftright("place", 33).alias("piece")
    in_piece = Window.partitionBy("conv", "piece").orderBy("place")
    linked = ordered.select("conv", "role", "place", piece).select(
        "*",
        F.lag("role").over(in_piece).alias("before"),
        (F.row_number().over(in_piece) - 1).alias("at"),
    )
    fault = F.when(F.col("at") > 0, turn_fault(F.col("role"), F.col("before"), F.lit(False)))
    runs = linked.withColumn("fault", fault).groupBy("conv", "piece").agg(
        F.count("*").alias("n"),
        F.min_by("role", "at").alias("first_role"),
        F.max_by("role", "at").alias("last_role"),
        F.min(F.when(F.col("fault").isNotNull(), F.struct("at", "fault"))).alias("inner"),
    )
    by_piece = Window.partitionBy("conv").orderBy("piece")
    joined = runs.select(
        "*",
        F.lag("last_role").over(by_piece).alias("before"),
        F.row_number().over(by_piece).alias("run"),
        (F.sum("n").over(by_piece) - F.col("n")).alias("ahead"),
    )
    meeting = turn_fault(F.col("first_role"), F.col("before"), F.col("run") == 1)
    inner = F.struct((F.col("ahead") + F.col("inner.at")).alias("at"), F.col("inner.fault").alias("fault"))
    # Ahead of a run's own first fault comes the one where it meets the run before.
    found = F.when(
        meeting.isNotNull(), F.struct(F.col("ahead").alias("at"), meeting.alias("fault"))
    ).when(F.col("inner").isNotNull(), inner)
    whole = joined.groupBy("conv").agg(
        F.sum("n").alias("n_turns"),
        F.min_by("first_role", "run").alias("first_role"),
        F.max_by("last_role", "run").alias("last_role"),
        F.min(found).alias("found"),
    )
    open_end = F.when(~F.col("last_role").eqNullSafe(ANSWERING), "open_end")
    return whole.select(
        F.col("conv").alias(conv_id),
        "n_turns",
        "first_role",
        "last_role",
        F.coalesce("found.fault", open_end).alias("fault"),
        F.coalesce("found.at", F.when(open_end.isNotNull(), F.col("n_turns") - 1)).alias("fault_at"),
    )
