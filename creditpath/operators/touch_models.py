"""First-touch and last-touch attribution (share of converting journeys)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import FIRST_TOUCH, LAST_TOUCH
from ..functions.numeric import round_half_up, share

#: Model and the journey column whose channel it credits.
CREDITS = {FIRST_TOUCH: "first_interaction", LAST_TOUCH: "last_interaction"}


def touch_attribution(
    journeys: DataFrame, digits: int | None = None, models: tuple[str, ...] = (FIRST_TOUCH, LAST_TOUCH)
) -> DataFrame:
    """``attribution_model, channel, attribution_percent`` of the given models, from one pass over the journeys.

    Counting per model and channel leaves a few rows; the total of converting
    journeys is then a sum over those.
    """
    credits = F.array(*[F.struct(F.lit(m).alias("attribution_model"), F.col(CREDITS[m]).alias("channel")) for m in models])
    counts = (
        journeys.where(F.col("conversion") == 1)
        .select(F.inline(credits))
        .groupBy("attribution_model", "channel")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy("attribution_model"))
    return counts.select(
        "attribution_model",
        "channel",
        round_half_up(share(F.col("n"), total), digits).alias("attribution_percent"),
    )


def first_touch(journeys: DataFrame, digits: int | None = None) -> DataFrame:
    """``attribution_model, channel, attribution_percent`` by first interaction."""
    return touch_attribution(journeys, digits, (FIRST_TOUCH,))


def last_touch(journeys: DataFrame, digits: int | None = None) -> DataFrame:
    return touch_attribution(journeys, digits, (LAST_TOUCH,))


def converting_journeys(journeys: DataFrame) -> DataFrame:
    """Global count of converting journeys (one row)."""
    return journeys.agg(F.count_if(F.col("conversion") == 1).alias("converting_journeys"))
