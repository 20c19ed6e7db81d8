"""Touches derived from the ``events`` table.

A journey is one user-day: ``uid = user_id || '-' || yyyyMMdd(ts)``. Events
are ordered by ``(ts, event_id)``; a touch converts when the next event of the
same user-day is a purchase. Purchases themselves are not touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import table_path
from ..operators.sequence import ordered_scan
from ..operators.validate import reject_reason

# Fixed value: the event type that marks a conversion.
PURCHASE = "purchase"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "events"))


def touches_from_events(
    events: DataFrame,
    conversion_event: str = PURCHASE,
    num_partitions: int | None = None,
) -> DataFrame:
    """``uid, channel, time, conversion, event_id, prev_touch`` — one row per event that isn't a purchase.

    An event without a user has a NULL uid and never converts; one without a
    type is a touch without a channel: both are left for validation to reject.
    One ordered scan of the events gives both the conversion flag (the next
    event) and ``prev_touch``, the previous valid touch of the same journey
    (purchases and rows that validation rejects are skipped), so that the
    transitions need no second pass over the touches.
    """
    ev = events.select(
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("uid"),
        F.col("user_id").alias("_user"),
        F.to_date("ts").alias("_day"),
        F.col("event_type").alias("channel"),
        F.col("ts").alias("time"),
        F.col("event_id"),
    )
    purchase = F.col("channel").eqNullSafe(conversion_event)
    ev = ev.withColumn("_touch", F.when(~purchase & reject_reason().isNull(), F.trim("channel")))
    # The journey key is (user, day); that numeric pair is cheaper to sort than the equivalent uid text.
    scanned = ordered_scan(
        ev, ["_user", "_day"], ["time", "event_id"], ["channel"], last_valid=["_touch"], num_partitions=num_partitions
    )
    converts = F.col("next_channel").eqNullSafe(conversion_event) & F.col("uid").isNotNull()
    return scanned.where(~purchase).select(
        "uid",
        "channel",
        "time",
        F.when(converts, 1).otherwise(0).cast("int").alias("conversion"),
        "event_id",
        F.col("prev__touch").alias("prev_touch"),
    )


def touches(spark: SparkSession, sf_dir: str, num_partitions: int | None = None) -> DataFrame:
    return touches_from_events(read_events(spark, sf_dir), num_partitions=num_partitions)
