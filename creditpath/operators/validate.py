"""V1: keep touches that cannot corrupt the state graph apart from the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RESERVED_STATES

REASON = "reject_reason"


def reject_reason(
    uid: str = "uid", channel: str = "channel", time: str = "time"
) -> Column:
    """First reason a touch is unusable, or NULL when it is fine."""
    ch = F.col(channel)
    return (
        F.when(F.col(uid).isNull() | (F.trim(F.col(uid)) == ""), F.lit("missing uid"))
        .when(F.col(time).isNull(), F.lit("missing time"))
        .when(ch.isNull() | (F.trim(ch) == ""), F.lit("missing channel"))
        .when(F.trim(ch).isin(*RESERVED_STATES), F.lit("reserved channel name"))
        .when(F.instr(ch, ">") > 0, F.lit("separator in channel name"))
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)``; ``rejected`` carries ``reject_reason``.

    Both sides come from one projection, so a caller that writes both reads
    the input once per side but evaluates the same rule.
    """
    tagged = df.withColumn(REASON, reject_reason())
    good = tagged.where(F.col(REASON).isNull()).drop(REASON)
    bad = tagged.where(F.col(REASON).isNotNull())
    return good, bad
