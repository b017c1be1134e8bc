"""Numeric helpers: rounding that two engines agree on, and a safe division.

Rounding to a few decimals is done decimal-first (double -> decimal with 10
decimal places -> target scale, half-up), which agrees between Spark and
other SQL engines where a plain ``round(double, n)`` does not. The 10-place
step only moves a value that lies within 5e-11 of a rounding tie. NaN,
infinities and magnitudes from 1e20 (whole numbers already) stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

# Decimal places of the first conversion step of decimal-first rounding.
GUARD_SCALE = 10


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, scale: int = 2) -> Column:
    """Decimal-first rounding of a double, returned as a double."""
    value = _col(c).cast(DoubleType())
    guarded = value.try_cast(DecimalType(30, GUARD_SCALE))
    return F.coalesce(guarded.cast(DecimalType(28, scale)).cast(DoubleType()), value)


def above(c: Column, threshold: float) -> Column:
    """``c > threshold`` with NaN above nothing (Spark orders NaN above every number)."""
    return ~F.isnan(c) & (c > threshold)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, null when the denominator is 0 or null."""
    return numerator.cast(DoubleType()) / F.nullif(denominator, F.lit(0))
