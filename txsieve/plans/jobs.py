"""The three jobs: train, score, stream."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from txsieve.operators.iforest import AnomalyModel, fit_isolation_forest
from txsieve.operators.reports import model_metrics
from txsieve.operators.scoring import score_report
from txsieve.schemas import CONTAMINATION, FEATURES, MAX_SAMPLES, N_TREES, SEED
from txsieve.sources.exports import write_anomalies_csv
from txsieve.sources.history import DEFAULT_FORMAT, read_history
from txsieve.sources.registry import load_model, save_model
from txsieve.sources.runlog import append_run, metrics_frame, params_frame, read_metrics
from txsieve.streaming.pipelines import start_pipeline


@dataclass(frozen=True)
class TrainingRun:
    run_id: str
    version: int
    model: AnomalyModel
    scored: DataFrame
    metrics: DataFrame
    csv_written: bool


def train_on(
    rows: DataFrame,
    out: str,
    keep: tuple[str, ...] = ("hash", *FEATURES),
    n_trees: int = N_TREES,
    max_samples: int = MAX_SAMPLES,
    contamination: float = CONTAMINATION,
    seed: int = SEED,
    caps: str = "exact",
) -> TrainingRun:
    """Fit, measure, log, register and export below ``out``.

    ``rows`` carries a ``row_id`` column, see ``fit_isolation_forest``. Metrics
    and export use the ``keep`` columns, with features uncapped.
    """
    spark = rows.sparkSession
    run_id = uuid.uuid4().hex
    model, scored = fit_isolation_forest(
        rows,
        keep=keep,
        n_trees=n_trees,
        max_samples=max_samples,
        contamination=contamination,
        seed=seed,
        caps=caps,
    )
    params = {"contamination": contamination, "n_estimators": n_trees, "random_state": seed}
    append_run(
        f"{out}/runs",
        params_frame(spark, run_id, params),
        metrics_frame(model_metrics(scored), run_id),
    )
    version = save_model(spark, f"{out}/models", model)
    csv_written = write_anomalies_csv(scored, f"{out}/anomalies/run={run_id}")
    logged = read_metrics(spark, f"{out}/runs").where(f"run_id = '{run_id}'")
    return TrainingRun(run_id, version, model, scored, logged, csv_written)


def train(
    spark: SparkSession, history: str, out: str, fmt: str = DEFAULT_FORMAT, **settings: object
) -> TrainingRun:
    """Train on the history table; a missing table is an error."""
    return train_on(read_history(spark, history, fmt, row_id=True), out, **settings)


def score(transactions: DataFrame, models: str, version: int | None = None) -> DataFrame:
    """Verdicts from a registered model, by default the newest one."""
    model = load_model(transactions.sparkSession, models, version)
    return score_report(transactions, model)


def stream(messages: DataFrame, out: str, checkpoint: str, **settings: object) -> None:
    """Run the message pipeline until one of its queries ends."""
    streams = messages.sparkSession.streams
    streams.resetTerminated()  # queries that ended earlier must not end this wait
    start_pipeline(messages, out, checkpoint, **settings)
    streams.awaitAnyTermination()
