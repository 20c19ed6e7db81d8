"""Banker's rounding of doubles equals the language's own on exact binary values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from creditpath.functions.numeric import round_half_even


def values(n, seed):
    rnd = random.Random(seed)
    out = [0.0, -0.0, 0.5, 1.5, 2.5, -2.5, 2.675, 1.005, 0.125, 0.375, 0.045, 1e-300, 5e-324, 4503599627370495.5]
    for _ in range(n):
        out.append(rnd.choice([-1, 1]) * rnd.random() * 10 ** rnd.randint(-6, 9))
        tie = (rnd.randint(0, 10**rnd.randint(1, 9)) * 2 + 1) / 2 / 10 ** rnd.randint(0, 6)  # a tie in decimal text
        out += [tie, -tie, math.nextafter(tie, 0), math.nextafter(tie, 1e300)]
        out.append(rnd.randint(-(2**30), 2**30) / 2 ** rnd.randint(1, 12))  # ties in binary
    return out


@pytest.mark.parametrize("digits", [0, 1, 2, 3, 6])
def test_equals_the_languages_round(spark, digits):
    given = values(20_000, digits)
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i long, v double")
    got = {r.i: r.r for r in rows.select("i", round_half_even(F.col("v"), digits).alias("r")).collect()}
    wrong = [(v, got[i], round(v, digits)) for i, v in enumerate(given) if got[i] != round(v, digits)]
    assert not wrong, (len(wrong), wrong[:5])


def test_other_values(spark):
    rows = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (1e300,)], "v double")
    got = [r.r for r in rows.select(round_half_even(F.col("v"), 2).alias("r")).collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2] == math.inf and got[3] == 1e300
    whole = spark.range(3).select(round_half_even(F.col("id"), 2).alias("r")).collect()
    assert [r.r for r in whole] == [0, 1, 2]
