from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TX_SCHEMA = (
    "hash string, size int, weight int, fee bigint, inputs_count int, outputs_count int, "
    "input_value bigint, output_value bigint"
)


def transactions(spark: SparkSession, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), TX_SCHEMA)


def plan(df: DataFrame) -> str:
    """Formatted physical plan as text."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=str)
