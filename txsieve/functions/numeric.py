"""Ratios, caps and scaling as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: str, denominator: str) -> Column:
    """``numerator / denominator``; NULL when the denominator is 0 or NULL."""
    return F.try_divide(F.col(numerator), F.col(denominator))


def guarded_ratio(numerator: str, denominator: str) -> Column:
    """``numerator / denominator`` with a denominator of at least 1.

    A NULL denominator stays NULL (``greatest`` alone would turn it into 1).
    """
    floor = F.greatest(F.col(denominator), F.lit(1))
    return F.when(F.col(denominator).isNotNull(), F.col(numerator) / floor)


def falsy_default(name: str, default: object) -> Column:
    """``default`` in place of NULL, 0 and the empty string."""
    empty = "" if isinstance(default, str) else 0
    return F.coalesce(F.nullif(F.col(name), F.lit(empty)), F.lit(default))


def capped(value: Column, cap: float | None) -> Column:
    """Clip from above. ``least`` ignores NULL, so NULL is kept by hand."""
    if cap is None:
        return value
    return F.when(value.isNotNull(), F.least(value, F.lit(float(cap))))


def standardized(value: Column, mean: float, sd: float) -> Column:
    """Zero mean, unit population deviation; a constant column becomes 0."""
    return (value - F.lit(float(mean))) / F.lit(float(sd) if sd else 1.0)
