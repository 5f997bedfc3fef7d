"""Verdicts for transactions: score, flag and explanation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txsieve.operators.enrich import with_explanation, with_guarded_ratios
from txsieve.operators.iforest import AnomalyModel


def score_report(df: DataFrame, model: AnomalyModel) -> DataFrame:
    """One verdict per request row; batch or streaming.

    Ratios are computed with guarded denominators, and the fitted caps and
    scales of training are applied. A row with a missing feature cannot be
    scored: its score, flag and explanation are NULL, which the error counter
    reports.
    """
    explained = with_explanation(model.score(with_guarded_ratios(df)))
    return explained.select(
        F.col("hash").alias("transaction_hash"),
        "anomaly_score",
        "is_anomaly",
        F.when(F.col("anomaly_score").isNotNull(), F.col("explanation")).alias("explanation"),
    )
