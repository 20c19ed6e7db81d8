"""All-model report and the channel x model frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FIRST_TOUCH, LAST_TOUCH, MARKOV_CHAIN

MODELS = [FIRST_TOUCH, LAST_TOUCH, MARKOV_CHAIN]


def all_models(*frames: DataFrame) -> DataFrame:
    """Union of ``attribution_model, channel, attribution_percent`` frames."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def attribution_pivot(attribution: DataFrame, models: list[str] | None = None) -> DataFrame:
    """One row per channel, one column per model (NULL where a model has no row)."""
    return (
        attribution.groupBy("channel")
        .pivot("attribution_model", models or MODELS)
        .agg(F.first("attribution_percent"))
    )
