"""Mergeable states of the feature columns: fit on stored sums and sketches, not on the history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txsieve.operators.features import complete_rows
from txsieve.operators.quantiles import SKETCH_SIZE
from txsieve.schemas import CAP_QUANTILE, FEATURES
from txsieve.sources import commits


def feature_states(df: DataFrame, features: list[str] = FEATURES, by: str = commits.DATE_COLUMN) -> DataFrame:
    """One row per value of ``by`` and feature: ``n, mean, m2`` (squared deviations), ``max_abs`` and a KLL ``sketch``.

    Complete rows only. All parts are partial aggregates of constant size, so a date that holds most
    rows is reduced in every task before the shuffle.
    """
    values = complete_rows(df.select(by, *[F.col(name).cast("double").alias(name) for name in features]), features)
    parts = [
        part
        for name in features
        for part in (
            F.avg(name).alias(f"{name}_mean"),
            (F.var_pop(name) * F.count(name)).alias(f"{name}_m2"),
            F.max(F.abs(name)).alias(f"{name}_max_abs"),
            F.kll_sketch_agg_double(name, SKETCH_SIZE).alias(f"{name}_sketch"),
        )
    ]
    entries = [
        F.struct(
            F.lit(name).alias("feature"),
            *[F.col(f"{name}_{part}").alias(part) for part in ("mean", "m2", "max_abs", "sketch")],
        )
        for name in features
    ]
    wide = values.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *parts)
    return wide.select(by, "n", F.inline(F.array(*entries)))


def store_states(rows: DataFrame, path: str, commit: str | None = None, features: list[str] = FEATURES) -> str:
    """Add the states of new ``rows`` to the table at ``path``; a batch of a stream passes its commit and counts once."""
    return commits.commit_rows(feature_states(rows, features), path, commit)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return commits.read_commits(spark, path)


def merged_states(states: DataFrame, q: float = CAP_QUANTILE) -> DataFrame:
    """``feature, n, mean, sd, max_abs, cap`` of all rows behind ``states``.

    Moments merge exactly up to rounding: squared deviations are moved to the common mean. ``cap`` is
    the ``q`` quantile of the merged sketches, with a rank error below 0.1 % for each of a few merges.
    """
    means = states.groupBy("feature").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("common"))
    moved = F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("common"), F.lit(2.0))
    return (
        # one row a feature
        states.join(F.broadcast(means), "feature")
        .groupBy("feature")
        .agg(
            F.sum("n").alias("n"),
            F.first("common").alias("mean"),
            F.sqrt(F.sum(moved) / F.sum("n")).alias("sd"),
            F.max("max_abs").alias("max_abs"),
            F.kll_merge_agg_double("sketch").alias("sketch"),
        )
        .select("feature", "n", "mean", "sd", "max_abs", F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("cap"))
    )
