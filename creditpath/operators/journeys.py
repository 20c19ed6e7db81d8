"""Journeys: order inside a uid, first and last touch, conversion flag.

Order inside a journey is ``(time, event_id)`` when the touches carry an
event id, else ``(time, channel)``. ``visit_order`` is ``dense_rank`` by time
(equal times share a rank). A journey is one row per touch, so that no row
and no group holds a whole journey, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import ordered_scan


def order_columns(touches: DataFrame) -> list[str]:
    tie = "event_id" if "event_id" in touches.columns else "channel"
    return ["time", tie]


def order_key(touches: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in order_columns(touches)])


def journey_summary(touches: DataFrame) -> DataFrame:
    """One row per uid: ``first_interaction, last_interaction, conversion, n_touches``.

    Only ``min_by``/``max_by``/``count``: each map task folds its rows of a uid
    into one partial row before the shuffle, so a hot uid costs one row per
    task, not one list. ``conversion`` is the last non-NULL flag.
    """
    key = order_key(touches)
    flag_key = F.when(F.col("conversion").isNotNull(), key)
    return touches.groupBy("uid").agg(
        F.min_by("channel", key).alias("first_interaction"),
        F.max_by("channel", key).alias("last_interaction"),
        F.max_by("conversion", flag_key).alias("conversion"),
        F.count(F.lit(1)).alias("n_touches"),
    )


def visit_order(touches: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Touches plus ``visit_order`` = dense_rank() over (uid order by time)."""
    return ordered_scan(
        touches,
        ["uid"],
        order_columns(touches),
        dense_rank_col="visit_order",
        rank_value="time",
        num_partitions=num_partitions,
    )


def user_journey(
    touches: DataFrame, num_partitions: int | None = None, summary: DataFrame | None = None
) -> DataFrame:
    """One row per touch: its place (``seq`` from 1, ``visit_order``), the channel before it, and the journey's facts.

    Columns: ``uid, seq, visit_order, previous_channel, channel, first_interaction,
    last_interaction, conversion, n_touches``. The journey's own columns repeat on
    each of its rows. They are joined on the uid, where the summary has one
    row each, so a skewed uid can be split on the touches' side.
    """
    ranked = ordered_scan(
        touches,
        ["uid"],
        order_columns(touches),
        ["channel"],
        seq_col="seq",
        dense_rank_col="visit_order",
        rank_value="time",
        num_partitions=num_partitions,
    )
    summary = summary if summary is not None else journey_summary(touches)
    facts = summary.select("uid", "first_interaction", "last_interaction", "conversion", "n_touches")
    return ranked.drop("conversion").join(facts, "uid").select(
        "uid", "seq", "visit_order", F.col("prev_channel").alias("previous_channel"), "channel",
        "first_interaction", "last_interaction", "conversion", "n_touches",
    )
