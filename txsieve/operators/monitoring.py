"""Operational metrics as aggregates over real rows.

The grouping columns here have few values, so every aggregate is reduced on
the map side to at most one row per value and task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bounds of the processing-time buckets, in seconds, and
# the two values of the status label.
LATENCY_BUCKETS = [0.1, 0.5, 1.0, 2.0, 5.0, 10.0]
STATUS_NORMAL = "normal"
STATUS_ANOMALOUS = "anomalous"


def processed_counter(df: DataFrame) -> DataFrame:
    """Transactions processed by status; unscored ones are errors and not processed."""
    status = F.when(F.col("is_anomaly"), STATUS_ANOMALOUS).otherwise(STATUS_NORMAL)
    scored = df.where(F.col("is_anomaly").isNotNull())
    return scored.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("value"))


def latest_score(df: DataFrame) -> DataFrame:
    """Score of the most recent transaction; the hash breaks ties."""
    recency = F.struct("transaction_time", "hash")
    return df.agg(F.max_by("anomaly_score", recency).alias("value"))


def latency_histogram(df: DataFrame, column: str, buckets: list[float] | None = None) -> DataFrame:
    """Cumulative ``le`` buckets with the total count and sum on every row."""
    bounds = buckets or LATENCY_BUCKETS
    observed = F.col(column)
    counts = df.agg(
        *[F.count_if(observed <= F.lit(bound)).alias(f"b{i}") for i, bound in enumerate(bounds)],
        F.count(observed).alias("count"),
        F.sum(observed).alias("sum"),
    )
    entries = [
        F.struct(F.lit(str(bound)).alias("le"), F.col(f"b{i}").alias("bucket_count"))
        for i, bound in enumerate(bounds)
    ] + [F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("bucket_count"))]
    return counts.select("count", "sum", F.inline(F.array(*entries)))


def latency_summary(df: DataFrame, column: str, label: str = "endpoint") -> DataFrame:
    """Count and sum of observations by endpoint."""
    return df.groupBy(label).agg(
        F.count(column).alias("count"), F.coalesce(F.sum(column), F.lit(0.0)).alias("sum")
    )


def consumer_lag(offsets: DataFrame, processed: object) -> DataFrame:
    """Messages behind, per partition.

    ``offsets`` holds one row per message (``partition``, ``offset``);
    ``processed`` is the condition that a message has been handled. A partition
    with nothing handled lags by all its messages.
    """
    newest = F.max("offset")
    done = F.max(F.when(processed, F.col("offset")))
    return offsets.groupBy("partition").agg(
        (newest - F.coalesce(done, F.min("offset") - 1)).alias("lag")
    )


def table_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Stored bytes and data files of a table in any format.

    The file listing is the input, so the cost follows the number of files and
    no data is read. Spark's listing leaves out names that start with ``_`` or ``.``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("files")
    )


def prediction_errors(df: DataFrame, label: str | None = None) -> DataFrame:
    """Rows that could not be scored, optionally by a label column."""
    errors = F.count_if(F.col("anomaly_score").isNull()).alias("value")
    return df.groupBy(label).agg(errors) if label else df.agg(errors)
