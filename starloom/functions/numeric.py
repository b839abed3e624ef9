"""Exact decimal arithmetic for rounded ratios (never round a DOUBLE)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_ratio(num: Column, den: Column, scale: int) -> Column:
    """ROUND(num / den, scale) in decimals, half away from zero. A zero
    ``den`` fails the query (ANSI), as the SQL it mirrors does."""
    # decimal(20,0) / decimal(20,0) keeps 18 fractional digits, so the one
    # rounding below is exact for any ratio of counts.
    n = num.cast("decimal(20,0)")
    d = den.cast("decimal(20,0)")
    return F.round(n / d, scale)


def pct(num: Column, den: Column, scale: int) -> Column:
    """ROUND(100.0 * num / den, scale) in decimals."""
    return round_ratio(num * F.lit(100), den, scale)
