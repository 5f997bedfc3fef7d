"""Attaching predictions to transactions by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts into which the rows of a key are spread.
SALTS = 4


def attach_scores(
    df: DataFrame, scores: DataFrame, key: str = "hash", salts: int = SALTS
) -> DataFrame:
    """Inner join of transactions to their predictions; ``df`` may be a stream.

    The score side is reduced to one row per key (the highest score, flagged if
    any copy is), so copies of a transaction never pair up with each other. Rows
    of a key are spread over ``salts`` parts by a hash of the whole row, with the one
    score row copied to each part; what is still too much for a reducer is split by
    adaptive execution. Nothing is counted before. Exact copies of a row hash
    alike and stay together for the adaptive split. Scores computed
    in place by ``AnomalyModel.score`` need no join at all; this is for
    predictions that live in a table of their own.
    """
    per_key = scores.groupBy(key).agg(
        F.max("anomaly_score").alias("anomaly_score"), F.bool_or("is_anomaly").alias("is_anomaly")
    )
    row = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])
    left = df.withColumn("_salt", F.pmod(row, F.lit(salts)).cast("int"))
    right = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "_salt"], "inner").drop("_salt")
