"""Report queries over the filtered view (transactions + score + flag)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txsieve.functions import text
from txsieve.functions.clock import hour_floor
from txsieve.operators.filters import anomalies_only

# Report sizes.
HISTOGRAM_BINS = 30
RECENT_ROWS = 10


def kpi_cards(df: DataFrame, only_anomalies: bool = False) -> DataFrame:
    """Row count, anomaly count, mean fee rate and mean size, with display text."""
    cards = anomalies_only(df, only_anomalies).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if("is_anomaly").alias("total_anomalies"),
        F.avg("fee_rate").alias("avg_fee_rate"),
        F.avg("size").alias("avg_tx_size"),
    )
    return cards.withColumns(
        {
            "total_transactions_text": text.thousands(F.col("total_transactions")),
            "total_anomalies_text": text.thousands(F.col("total_anomalies")),
            "avg_fee_rate_text": text.two_decimals(F.col("avg_fee_rate")),
            "avg_tx_size_text": text.thousands(F.col("avg_tx_size")),
        }
    )


def hourly_counts(df: DataFrame, only_anomalies: bool = False) -> DataFrame:
    return (
        anomalies_only(df, only_anomalies)
        .groupBy(hour_floor(F.col("transaction_time")).alias("hour"), "is_anomaly")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def hourly_stacked(df: DataFrame, only_anomalies: bool = False) -> DataFrame:
    """The series side by side, with the top edge of the stacked area.

    Rows without a score are a series of their own, so ``total`` counts every row.
    """
    return (
        anomalies_only(df, only_anomalies)
        .groupBy(hour_floor(F.col("transaction_time")).alias("hour"))
        .agg(
            F.count_if(~F.col("is_anomaly")).alias("normal"),
            F.count_if("is_anomaly").alias("anomalous"),
            F.count_if(F.col("is_anomaly").isNull()).alias("unscored"),
            F.count(F.lit(1)).alias("total"),
        )
    )


def score_histogram(df: DataFrame, bins: int = HISTOGRAM_BINS, threshold: float = 1.0) -> DataFrame:
    """Equal-width bins over the observed score range; empty bins are left out.

    The range comes from scalar subqueries that Spark merges into one
    aggregate. A single distinct score puts every row into bin 0.
    """
    scores = df.select("anomaly_score").where(F.col("anomaly_score").isNotNull())
    bounds = scores.agg(F.min("anomaly_score").alias("low"), F.max("anomaly_score").alias("high"))
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    place = F.try_divide(F.col("anomaly_score") - low, high - low)
    bin_no = F.least(F.floor(F.coalesce(place, F.lit(0.0)) * bins), F.lit(bins - 1)).cast("int")
    counted = scores.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (high - low) / F.lit(bins)
    return counted.select(
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        "count",
        F.lit(float(threshold)).alias("threshold"),
    )


def scatter_projection(df: DataFrame, only_anomalies: bool = False) -> DataFrame:
    """All points of the fee-rate-by-size plot; no sampling."""
    return anomalies_only(df, only_anomalies).select(
        "size", "fee_rate", "is_anomaly", "hash", "fee", "inputs_count", "outputs_count"
    )


def recent_table(
    df: DataFrame, only_anomalies: bool = False, rows: int = RECENT_ROWS
) -> DataFrame:
    """Newest transactions as display text; the hash breaks ties in time.

    The limit is the report. Sorting and limiting happen on raw columns before
    formatting, so that Spark plans a per-task top-k.
    """
    newest = (
        anomalies_only(df, only_anomalies)
        .orderBy(F.col("transaction_time").desc_nulls_last(), "hash")
        .limit(rows)
    )
    return newest.select(
        text.display_time(F.col("transaction_time")).alias("time"),
        text.short_hash(F.col("hash")).alias("hash"),
        text.thousands(F.col("size")).alias("size"),
        text.thousands(F.col("fee")).alias("fee"),
        text.two_decimals(F.col("fee_rate")).alias("fee_rate"),
        text.two_decimals(F.col("anomaly_score")).alias("anomaly_score"),
        text.status_label(F.col("is_anomaly")).alias("status"),
    )


def model_metrics(df: DataFrame) -> DataFrame:
    """One row of training metrics on uncapped values.

    Normal and anomalous rows are separated by conditional aggregation, so the
    scored table is read once.
    """
    flagged = F.col("is_anomaly")

    def mean_where(condition: object, name: str) -> object:
        return F.avg(F.when(condition, F.col(name)))

    averages = [
        mean_where(condition, name).alias(f"avg_{label}_{name}")
        for name in ("fee", "size", "fee_rate")
        for label, condition in (("normal", ~flagged), ("anomaly", flagged))
    ]
    return df.agg(
        F.count(F.lit(1)).alias("num_transactions"),
        F.count_if(flagged).alias("num_anomalies"),
        (F.try_divide(F.count_if(flagged), F.count(F.lit(1))) * 100).alias("anomaly_percentage"),
        *averages,
    )


def metrics_long(metrics: DataFrame) -> DataFrame:
    """One metrics row as ``key``/``value`` rows."""
    doubles = metrics.select(*[F.col(name).cast("double").alias(name) for name in metrics.columns])
    return doubles.unpivot([], doubles.columns, "key", "value")
