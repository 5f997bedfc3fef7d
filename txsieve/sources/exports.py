"""Flagged transactions as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_anomalies_csv(scored: DataFrame, path: str) -> bool:
    """Write flagged rows with a header; nothing is written if there are none.

    Returns whether a folder was written. The folder holds one file per task.
    """
    flagged = scored.where("is_anomaly")
    if flagged.isEmpty():
        return False
    flagged.write.mode("errorifexists").option("header", True).csv(path)
    return True


def read_anomalies_csv(like: DataFrame, path: str) -> DataFrame:
    """Read an export back with the schema of the exported frame."""
    return like.sparkSession.read.schema(like.schema).option("header", True).csv(path)
