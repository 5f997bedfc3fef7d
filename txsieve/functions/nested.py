"""Lengths and sums over arrays of structs, with missing parts counted as zero."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_length(items: Column) -> Column:
    return F.coalesce(F.array_size(items), F.lit(0))


def array_total(items: Column, pick: Callable[[Column], Column]) -> Column:
    """Sum of ``pick(item)`` over the array as bigint, NULL if it overflows.

    A missing array counts as zero, and so does a missing item, struct or field.
    """
    zero = F.lit(0).cast("bigint")
    total = F.aggregate(
        items, zero, lambda acc, item: F.try_add(acc, F.coalesce(pick(item), zero))
    )
    return F.when(items.isNull(), zero).otherwise(total)
