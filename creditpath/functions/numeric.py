"""Division and rounding helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(numerator: Column, denominator: Column) -> Column:
    """Ratio as double; NULL instead of an error when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_half_up(c: Column, digits: int | None) -> Column:
    """SQL ``round`` (HALF_UP on the decimal value); ``None`` leaves it as is."""
    return c if digits is None else F.round(c, digits)


#: 2^27 + 1 parts a double into two halves whose products are exact.
SPLITTER = float((1 << 27) + 1)


def _halves(x: Column) -> tuple[Column, Column]:
    big = x * F.lit(SPLITTER)
    high = big - (big - x)
    return high, x - high


def round_half_even(c: Column, digits: int | None) -> Column:
    """Python's ``round`` of a double: the exact binary value decides, and only true ties go to the even digit.

    ``bround`` looks at the shortest decimal text instead, so that it takes
    2.675 (just below) and 1.005 (just below) for ties. Here the value times
    10^digits is a product and its exact rounding error, both doubles, and the
    sign of (product - floor - 1/2) + error is that of the exact sum. Products
    of 2^52 or more, and negative or over 22 digits, are left to ``bround``.
    """
    if digits is None:
        return c
    if not 0 <= digits <= 22:
        return F.bround(c, digits)
    x, scale = F.abs(c.cast("double")), F.lit(10.0**digits)
    product = x * scale
    (a, b), high = _halves(x), 10.0**digits
    t = high * SPLITTER
    s_high = t - (t - high)
    s_low = F.lit(high - s_high)
    error = ((a * s_high - product) + a * s_low + b * s_high) + b * s_low
    down = F.floor(product).cast("double")
    over = (product - down - F.lit(0.5)) + error
    odd = F.pmod(down, F.lit(2.0)) == 1.0
    up = (over > 0) | ((over == 0) & odd)
    # a product rounded up to a whole number from below still has its floor one lower
    whole = F.when(up, down + 1.0).otherwise(down)
    rounded = whole / scale * F.when(c < 0, -1.0).otherwise(1.0)
    return F.when(product < float(1 << 52), rounded).otherwise(F.bround(c.cast("double"), digits))
