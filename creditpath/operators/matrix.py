"""Transition matrix and its derived views.

The matrix has one row per observed edge, so its size is bounded by the
square of the number of states, whatever the number of touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import round_half_up, share


def transition_matrix(counts: DataFrame) -> DataFrame:
    """``start_state, end_state, transition_probability`` = count / row total.

    The row total is a window sum over the (small) count table instead of a
    second aggregate joined back.
    """
    total = F.sum("total_transitions").over(Window.partitionBy("start_state"))
    return counts.select(
        "start_state",
        "end_state",
        share(F.col("total_transitions"), total).alias("transition_probability"),
    )


def row_sums(matrix: DataFrame, digits: int | None = 2) -> DataFrame:
    """Per start state the sum of outgoing probabilities (each must be 1)."""
    return matrix.groupBy("start_state").agg(
        round_half_up(F.sum("transition_probability"), digits).alias("transition_probability_sum")
    )


def matrix_states(matrix: DataFrame) -> list[str]:
    """Sorted end states (a few names) for a fixed pivot column list."""
    return sorted(r[0] for r in matrix.select("end_state").distinct().collect())


def pivot_matrix(matrix: DataFrame, states: list[str] | None = None) -> DataFrame:
    """Wide form: one row per start state, one column per end state; NULL = no edge."""
    states = states if states is not None else matrix_states(matrix)
    return (
        matrix.groupBy("start_state")
        .pivot("end_state", states)
        .agg(F.first("transition_probability"))
    )


def adjacency(matrix: DataFrame) -> DataFrame:
    """``start_state, next_stages, next_stage_transition_probabilities``.

    One list of ``(end_state, p)`` pairs keeps both arrays aligned; the lists
    are ordered by end state descending.
    """
    pairs = F.sort_array(
        F.collect_list(F.struct("end_state", "transition_probability")), asc=False
    )
    return (
        matrix.groupBy("start_state")
        .agg(pairs.alias("_next"))
        .select(
            "start_state",
            F.col("_next.end_state").alias("next_stages"),
            F.col("_next.transition_probability").alias("next_stage_transition_probabilities"),
        )
    )
