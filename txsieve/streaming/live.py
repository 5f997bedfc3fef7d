"""What a running stream tells: late rows, verdicts of the newest model, observed metrics, latest scores."""

from __future__ import annotations

import json
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from txsieve.operators.monitoring import LATENCY_BUCKETS
from txsieve.operators.scoring import score_report
from txsieve.schemas import TRIGGER_INTERVAL, WATERMARK_DELAY, WINDOW_LENGTH
from txsieve.sources import commits, registry
from txsieve.streaming import progress
from txsieve.streaming.pipelines import triggered

TIME_SCHEMA = "batch long, latest timestamp"
METRIC_SCHEMA = (
    "query string, name string, batch long, rows long, seconds double, behind long, dropped long, "
    "sources string, observed map<string, double>"
)


def start_late_rows(
    transactions: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = TRIGGER_INTERVAL,
    length: str = WINDOW_LENGTH,
    delay: str = WATERMARK_DELAY,
) -> StreamingQuery:
    """Keep the rows that the window statistics leave out, with their batch.

    The latest event time of each batch goes to a table. The statistics leave out a row whose
    window has ended by the watermark of the batch before, which knows the batches before that; with the
    same source and the same bound on a batch, this query has the same batches and keeps these rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = batch.agg(F.lit(batch_id).cast("long").alias("batch"), F.max("transaction_time").alias("latest"))
        latest.write.mode("overwrite").parquet(f"{path}/times/{batch_id:012d}")
        times = spark.read.schema(TIME_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{path}/times")
        watermark = (
            times.where(F.col("batch") <= batch_id - 2)
            .agg((F.max("latest") - F.expr(f"interval {delay}")).alias("watermark"))
            .scalar()
        )
        end = F.window("transaction_time", length)["end"]
        late = batch.withColumn("window_end", end).where(F.col("window_end") <= watermark)
        late = late.withColumn("batch", F.lit(batch_id).cast("long"))
        commits.commit_rows(late, f"{path}/rows", commits.stream_commit(batch, batch_id))

    return triggered(transactions.writeStream.foreachBatch(write), checkpoint, trigger).queryName("late_rows").start()


def read_late_rows(spark: SparkSession, path: str) -> DataFrame:
    return commits.read_commits(spark, f"{path}/rows")


def start_newest_scores(
    transactions: DataFrame, models: str, path: str, checkpoint: str, trigger: str | None = TRIGGER_INTERVAL
) -> StreamingQuery:
    """Verdicts of the newest registered model, looked up for every batch, with its version.

    A batch that is run again keeps the verdicts it has.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = registry.latest_params(spark, models).first()["version"]
        report = score_report(batch, registry.load_model(spark, models, version))
        report = report.withColumn("model_version", F.lit(version))
        commits.commit_rows(report, path, commits.stream_commit(batch, batch_id))

    return triggered(transactions.writeStream.foreachBatch(write), checkpoint, trigger).queryName("newest_scores").start()


def observed_columns(seconds: Column | None = None) -> list[Column]:
    """Counters of scored rows by status and of errors, and cumulative buckets, count and sum of ``seconds``."""
    flag = F.col("is_anomaly")
    metrics = [
        F.count_if(~flag).alias("normal"),
        F.count_if(flag).alias("anomalous"),
        F.count_if(flag.isNull()).alias("errors"),
    ]
    if seconds is not None:
        metrics += [F.count_if(seconds <= F.lit(b)).alias(f"le_{b}") for b in LATENCY_BUCKETS]
        metrics += [F.count(seconds).alias("seconds_count"), F.sum(seconds).alias("seconds_sum")]
    return metrics


class BatchMetrics(StreamingQueryListener):
    """Stores one row per batch of the query ``name``: what ``DataFrame.observe`` saw, duration, offsets and lag.

    The numbers come with the batch's own pass over the rows. A row is written under its query and batch, so a
    report that comes twice is stored once. ``wait`` returns after the last report of a query that has ended.
    """

    def __init__(self, spark: SparkSession, path: str, name: str) -> None:
        self.spark, self.path, self.name = spark, path, name
        self.ended, self.failed = threading.Event(), None
        self.ids: set[str] = set()

    def onQueryStarted(self, event: object) -> None:
        if event.name == self.name:
            self.ids.add(str(event.id))

    def onQueryProgress(self, event: object) -> None:
        report = json.loads(event.progress.json)
        if report["name"] != self.name or not report["numInputRows"]:
            return
        try:
            self._store(report)
        except Exception as error:  # the listener bus would swallow it
            self.failed = error

    def _store(self, report: dict) -> None:
        observed = {
            name: float(value)
            for metrics in (report.get("observedMetrics") or {}).values()
            for name, value in metrics.items()
            if value is not None
        }
        row = (
            report["id"], report["name"], report["batchId"], report["numInputRows"], progress.processing_seconds(report),
            progress.messages_behind(report), progress.rows_dropped_late(report), json.dumps(report["sources"]), observed,
        )
        stored = self.spark.createDataFrame([row], METRIC_SCHEMA).coalesce(1)
        stored.write.mode("overwrite").parquet(f"{self.path}/{report['id']}-{report['batchId']:012d}")

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: object) -> None:
        if str(event.id) in self.ids:
            self.ended.set()

    def wait(self, seconds: float = 60) -> None:
        if not self.ended.wait(seconds):
            raise TimeoutError(f"no end of query {self.name} was reported")
        if self.failed:
            raise self.failed


def read_batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).option("recursiveFileLookup", "true").parquet(path)


def start_latest_scores(
    scored: DataFrame, path: str, checkpoint: str, label: str = "label", trigger: str | None = TRIGGER_INTERVAL
) -> StreamingQuery:
    """Latest score of each label, kept as state, so rows may come in any order.

    State is one row per label. Each batch writes the labels that changed.
    """
    recency = F.struct("transaction_time", "hash")
    latest = scored.groupBy(label).agg(
        F.max_by("anomaly_score", recency).alias("value"), F.max("transaction_time").alias("transaction_time")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        changed = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        commits.commit_rows(changed, path, commits.stream_commit(batch, batch_id))

    writer = latest.writeStream.outputMode("update").foreachBatch(write)
    return triggered(writer, checkpoint, trigger).queryName("latest_scores").start()


def read_latest_scores(spark: SparkSession, path: str, label: str = "label") -> DataFrame:
    """The last value that was written for each label."""
    written = commits.read_commits(spark, path)
    return written.groupBy(label).agg(F.max_by("value", "batch").alias("value"))
