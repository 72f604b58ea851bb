"""Exact ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_half_up(numerator: Column, denominator: Column, scale: int) -> Column:
    """Quotient of two non-negative whole numbers, rounded half up once; 0 if the divisor is 0.

    Whole-number arithmetic, so no intermediate rounding can tip a value over a half.
    """
    unit = 10**scale
    divisor = F.nullif(denominator, F.lit(0))
    steps = F.call_function("div", numerator * F.lit(2 * unit) + divisor, divisor * 2)
    value = steps.cast("decimal(20,0)") / F.lit(unit).cast("decimal(10,0)")
    return F.coalesce(value.cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)"))
