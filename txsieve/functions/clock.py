"""Event-time expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


#: First and last second of the years 1 to 9999.
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799


def epoch_to_timestamp(seconds: Column) -> Column:
    """Time of a Unix second; NULL outside the calendar, where a cast would fail or saturate."""
    return F.timestamp_seconds(F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds))


def hour_floor(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def range_hours(time_range: str) -> int | None:
    """``"6h"`` → 6, ``"all"`` → None."""
    if time_range == "all":
        return None
    match = re.fullmatch(r"(\d+)h", time_range)
    if match is None:
        raise ValueError(f"time range must be 'all' or hours such as '24h', got {time_range!r}")
    return int(match.group(1))


def hours_before(now: Column, hours: int) -> Column:
    return now - F.expr(f"INTERVAL '{hours}' HOUR")
