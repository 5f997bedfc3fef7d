"""Run parameters and metrics as two long, append-only tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txsieve.operators.reports import metrics_long
from txsieve.schemas import RUN_METRIC_SCHEMA, RUN_PARAM_SCHEMA


def params_frame(spark: SparkSession, run_id: str, params: dict[str, object]) -> DataFrame:
    rows = [(run_id, key, str(value)) for key, value in params.items()]
    return spark.createDataFrame(rows, RUN_PARAM_SCHEMA)


def metrics_frame(metrics: DataFrame, run_id: str, step: int = 0) -> DataFrame:
    """A one-row metrics frame as ``run_id, key, value, ts, step`` rows."""
    return metrics_long(metrics).select(
        F.lit(run_id).alias("run_id"),
        "key",
        "value",
        F.current_timestamp().alias("ts"),
        F.lit(step).alias("step"),
    )


def append_run(path: str, params: DataFrame, metrics: DataFrame) -> None:
    params.coalesce(1).write.mode("append").parquet(f"{path}/run_params")
    metrics.coalesce(1).write.mode("append").parquet(f"{path}/run_metrics")


def read_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_PARAM_SCHEMA).parquet(f"{path}/run_params")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_METRIC_SCHEMA).parquet(f"{path}/run_metrics")
