"""Rounding that follows the exact binary value of a DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exact(x: Column, digits: int) -> Column:
    """Round half-even on the exact binary value, as Python's ``round(x, digits)`` does.

    ``F.round`` works on the shortest decimal text instead, so it rounds 2.675 up although the
    stored value lies below it. Here the rounding error of ``x * 10**digits`` is computed
    exactly (Dekker splitting) and settles the cases where the product lands on a tie.
    """
    scale = float(10**digits)
    x = x.cast("double")
    product = x * F.lit(scale)
    spread = x * F.lit(134217729.0)
    high = spread - (spread - x)
    low = x - high
    error = (high * F.lit(scale) - product) + low * F.lit(scale)
    floor = F.floor(product).cast("double")
    nearest = (
        F.when(product - floor != F.lit(0.5), F.rint(product))
        .when(error > 0, floor + 1.0)
        .when(error < 0, floor)
        .otherwise(F.rint(product))
    )
    return nearest / F.lit(scale)


def fixed(x: Column, digits: int) -> Column:
    """Text of ``x`` with a fixed number of decimals, rounded like :func:`round_exact`."""
    if digits == 0:
        return F.rint(x.cast("double")).cast("bigint").cast("string")
    return F.format_string(f"%.{digits}f", round_exact(x, digits))
