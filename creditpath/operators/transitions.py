"""State transitions, two ways; state names are trimmed in both.

* :func:`touch_transitions` builds edges straight from touches: the previous
  touch of the same journey, an edge from ``Start`` for each first touch, and
  one terminal edge per journey.
* :func:`path_transitions` reads the stored journey, one row per touch, as
  ``'A > B'`` text; :func:`edges_from_path_transitions` splits it again.

Both give the same multiset of edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PATH_SEPARATOR, START_STATE
from ..functions.paths import split_transition, terminal_state, transition_array
from .journeys import journey_summary, order_columns
from .sequence import ordered_scan


def touch_transitions(
    touches: DataFrame,
    journeys: DataFrame | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """``uid, start_state, end_state`` — one row per edge of every journey.

    When the touches already carry ``prev_touch`` (the previous touch of the
    journey, e.g. from :func:`creditpath.sources.events.touches_from_events`)
    no scan is needed.
    """
    summary = journeys if journeys is not None else journey_summary(touches)
    touches = touches.withColumn("channel", F.trim("channel"))
    ends = summary.select(
        "uid",
        F.trim("last_interaction").alias("start_state"),
        terminal_state("conversion").alias("end_state"),
    )
    if "prev_touch" in touches.columns:
        inner = touches.select(
            "uid",
            F.coalesce(F.col("prev_touch"), F.lit(START_STATE)).alias("start_state"),
            F.col("channel").alias("end_state"),
        )
        return inner.unionByName(ends)
    scanned = ordered_scan(
        touches.select("uid", "channel", *[c for c in order_columns(touches) if c != "channel"]),
        ["uid"],
        order_columns(touches),
        ["channel"],
        num_partitions=num_partitions,
    )
    inner = scanned.select(
        "uid",
        F.coalesce(F.col("prev_channel"), F.lit(START_STATE)).alias("start_state"),
        F.col("channel").alias("end_state"),
    )
    return inner.unionByName(ends)


def path_transitions(user_journey: DataFrame) -> DataFrame:
    """``uid, transition, cnt`` — one row per ``'A > B'`` pair of each journey.

    A journey's last touch also gives the pair with its terminal state.
    """
    channel = F.trim("channel")
    into = F.concat_ws(PATH_SEPARATOR, F.coalesce(F.trim("previous_channel"), F.lit(START_STATE)), channel)
    last = F.concat_ws(PATH_SEPARATOR, channel, terminal_state("conversion"))
    pairs = F.when(F.col("seq") == F.col("n_touches"), F.array(into, last)).otherwise(F.array(into))
    return user_journey.select("uid", F.explode(pairs).alias("transition"), F.lit(1).alias("cnt"))


def text_transitions(paths: DataFrame) -> DataFrame:
    """``path, transition, cnt`` of any column ``path`` like ``A > B > C``."""
    return paths.select(
        "path", F.explode(transition_array("path")).alias("transition"), F.lit(1).alias("cnt")
    )


def edges_from_path_transitions(path_edges: DataFrame) -> DataFrame:
    return path_edges.select(
        split_transition("transition", 0).alias("start_state"),
        split_transition("transition", 1).alias("end_state"),
    )


def transition_counts(edges: DataFrame) -> DataFrame:
    """``start_state, end_state, total_transitions`` (partial aggregation first)."""
    return edges.groupBy("start_state", "end_state").agg(
        F.count(F.lit(1)).alias("total_transitions")
    )
