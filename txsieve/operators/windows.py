"""Tumbling-window statistics, one definition for batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txsieve.schemas import WATERMARK_DELAY, WINDOW_LENGTH


def window_stats(df: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """Counts, averages and totals per window of ``transaction_time``.

    Every aggregate has a constant-size partial state, so a window holding a
    large share of the rows is reduced on the map side to one row per task
    before the shuffle. Totals stay ``bigint``; one that overflows is NULL, so a
    single message cannot end a stream.
    """
    stats = df.groupBy(F.window("transaction_time", length)).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        *[
            F.avg(source).alias(name)
            for source, name in [
                ("fee", "avg_fee"),
                ("fee_rate", "avg_fee_rate"),
                ("size", "avg_size"),
                ("inputs_count", "avg_inputs"),
                ("outputs_count", "avg_outputs"),
            ]
        ],
        F.try_sum("input_value").alias("total_input_value"),
        F.try_sum("output_value").alias("total_output_value"),
    )
    return stats.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[name for name in stats.columns if name != "window"],
    )


def watermarked_window_stats(
    stream: DataFrame, length: str = WINDOW_LENGTH, delay: str = WATERMARK_DELAY
) -> DataFrame:
    """Streaming form: a window is final once the watermark passes its end."""
    return window_stats(stream.withWatermark("transaction_time", delay), length)
