"""Report filters. All of them are plain predicates that reach the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txsieve.functions.clock import hours_before, range_hours
from txsieve.operators.enrich import DEFAULT_THRESHOLD, flag_by_threshold

# The filter form's initial state.
DEFAULT_TIME_RANGE = "24h"
DEFAULT_SIZE_RANGE = (0, 10000)


def filter_time_range(
    df: DataFrame,
    time_range: str = DEFAULT_TIME_RANGE,
    now: Column | dt.datetime | str | None = None,
    column: str = "transaction_time",
    date_column: str = "event_date",
) -> DataFrame:
    """Rows of the last hours before ``now``.

    ``now`` is the current time by default; ``"latest"`` means the newest event
    time in ``df``, for reports on stored data. The bound is one scalar (for
    "latest" a scalar subquery over a single column), so the comparison can be
    pushed into the scan, and on a table partitioned by event date it also
    prunes partitions. The newest time is then looked for in the newest date only.
    """
    hours = range_hours(time_range)
    if hours is None:
        return df
    if isinstance(now, str):
        if now != "latest":
            raise ValueError(f"now must be a time or 'latest', got {now!r}")
        newest = df
        if date_column in df.columns:
            newest = df.where(F.col(date_column) == df.agg(F.max(date_column)).scalar())
        start = newest.agg(hours_before(F.max(column), hours).alias("start")).scalar()
    elif now is None:
        start = hours_before(F.current_timestamp(), hours)
    elif isinstance(now, dt.datetime):
        start = F.lit(now - dt.timedelta(hours=hours))
    else:
        start = hours_before(now, hours)
    kept = df.where(F.col(column) >= start)
    if date_column in df.columns:
        kept = kept.where(F.col(date_column) >= F.to_date(start))
    return kept


def filter_size_range(
    df: DataFrame, low: int = DEFAULT_SIZE_RANGE[0], high: int = DEFAULT_SIZE_RANGE[1]
) -> DataFrame:
    """Sizes between both bounds, bounds included."""
    return df.where(F.col("size").between(low, high))


def anomalies_only(df: DataFrame, enabled: bool = True) -> DataFrame:
    return df.where("is_anomaly") if enabled else df


def filtered_view(
    df: DataFrame,
    time_range: str = DEFAULT_TIME_RANGE,
    size_range: tuple[int, int] = DEFAULT_SIZE_RANGE,
    threshold: float = DEFAULT_THRESHOLD,
    now: Column | dt.datetime | str | None = None,
) -> DataFrame:
    """The frame every report reads: time range, size range, flag by threshold."""
    kept = filter_time_range(df, time_range, now)
    kept = filter_size_range(kept, *size_range)
    return flag_by_threshold(kept, threshold)
