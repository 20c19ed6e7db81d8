"""Degenerate inputs: no touches at all, and no conversions."""

import pytest
from pyspark.sql import functions as F

from creditpath.plans.attribution import AttributionPlan


def test_empty_touches(spark, toy_touches):
    p = AttributionPlan(toy_touches.where(F.lit(False)))
    assert p.touch_attribution.count() == 0
    assert p.matrix.count() == 0
    assert p.user_journey.count() == 0
    for policy in ("absorbing", "simple_path", "memo_walk"):
        assert p.markov_attribution(policy).count() == 0


@pytest.mark.parametrize("policy", ["absorbing", "simple_path", "memo_walk"])
def test_no_conversions_gives_null_effects(spark, toy_touches, policy):
    p = AttributionPlan(toy_touches.withColumn("conversion", F.lit(0)))
    assert p.first_touch.count() == 0
    rows = p.removal_effect(policy).collect()
    assert rows and all(r.conversion_probability == 0.0 for r in rows)
    assert all(r.removal_effect is None and r.attribution_percent is None for r in rows)
