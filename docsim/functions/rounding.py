"""Rounding to the nearest decimal, exact ties to the even neighbour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**27 + 1 splits a double into two halves whose products with small integers are exact.
SPLITTER = 134217729.0


def round_even(value: Column, digits: int) -> Column:
    """Round the exact binary value to ``digits`` decimals; a true tie goes to the even digit.

    SQL ``round`` sends ties up, so 1/32 becomes 0.0313 where the published figures of a
    Python program read 0.0312. ``value * 10**digits`` is one double plus an error term that
    the split recovers exactly, so the side of the tie is decided without decimals.
    """
    scale = float(10**digits)
    value = value.cast("double")
    product = value * F.lit(scale)
    spread = value * F.lit(SPLITTER)
    high = spread - (spread - value)
    error = (high * F.lit(scale) - product) + (value - high) * F.lit(scale)
    whole = F.floor(product).cast("double")
    excess = ((product - whole) - F.lit(0.5)) + error
    odd = F.pmod(whole, F.lit(2.0)) == F.lit(1.0)
    up = (excess > 0) | ((excess == 0) & odd)
    return (whole + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / F.lit(scale)
