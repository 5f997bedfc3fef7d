"""Ratio columns and flags added in place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txsieve.functions import text
from txsieve.functions.numeric import guarded_ratio, ratio

# Fixed value: score above which an unlabelled prediction counts as anomalous.
FALLBACK_LIMIT = 0.5
DEFAULT_THRESHOLD = 1.0


def with_ratios(df: DataFrame) -> DataFrame:
    """``fee_rate`` and ``fee_per_weight``; NULL where the denominator is 0."""
    return df.withColumns(
        {"fee_rate": ratio("fee", "size"), "fee_per_weight": ratio("fee", "weight")}
    )


def with_guarded_ratios(df: DataFrame) -> DataFrame:
    """The same two columns with denominators of at least 1, as scoring needs them."""
    return df.withColumns(
        {"fee_rate": guarded_ratio("fee", "size"), "fee_per_weight": guarded_ratio("fee", "weight")}
    )


def flag_by_threshold(df: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """``is_anomaly`` = score strictly above the threshold."""
    return df.withColumn("is_anomaly", F.col("anomaly_score") > F.lit(float(threshold)))


def flag_with_fallback(df: DataFrame) -> DataFrame:
    """``is_anomaly`` from a ±1 ``prediction``, otherwise from the score."""
    prediction = F.col("prediction")
    return df.withColumn(
        "is_anomaly",
        F.when(prediction.isin(-1, 1), prediction == -1).otherwise(
            F.col("anomaly_score") > F.lit(FALLBACK_LIMIT)
        ),
    )


def with_explanation(df: DataFrame, **limits: float) -> DataFrame:
    """Add ``explanation`` to flagged transactions; the fee rate is ``fee / size``."""
    return df.withColumn(
        "explanation",
        text.explanation(
            F.col("is_anomaly"),
            ratio("fee", "size"),
            F.col("size"),
            F.col("inputs_count"),
            F.col("outputs_count"),
            **limits,
        ),
    )


def rule_check(df: DataFrame) -> DataFrame:
    """Verdict from fixed limits, without a model."""
    rate = ratio("fee", "size")
    flag = text.breaks_rule(rate, F.col("size"))
    return df.select(
        F.col("hash").alias("transaction_hash"),
        text.rule_score(flag).alias("anomaly_score"),
        flag.alias("is_anomaly"),
        text.rule_explanation(flag, rate).alias("explanation"),
    )
