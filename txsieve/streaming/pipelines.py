"""Message stream → history table, window statistics and live scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from txsieve.operators.enrich import with_ratios
from txsieve.operators.iforest import AnomalyModel
from txsieve.operators.records import decode_messages, with_event_time
from txsieve.operators.scoring import score_report
from txsieve.operators.windows import watermarked_window_stats
from txsieve.schemas import TRIGGER_INTERVAL, WATERMARK_DELAY, WINDOW_LENGTH
from txsieve.sources import commits
from txsieve.sources.history import DATE_COLUMN, DEFAULT_FORMAT, with_event_date


def enriched(messages: DataFrame) -> DataFrame:
    """Decoded messages with event time, processing time, ratios and identity; batch or streaming."""
    return with_ratios(with_event_time(decode_messages(messages, identify=True)))


def table_writer(
    stream: DataFrame,
    checkpoint: str,
    fmt: str = DEFAULT_FORMAT,
    trigger: str | None = TRIGGER_INTERVAL,
    partition_by: str | None = None,
) -> DataStreamWriter:
    """Append writer with its own checkpoint.

    ``trigger`` is a processing-time interval; None processes what is available
    and stops, which suits backfills and tests.
    """
    writer = stream.writeStream.format(fmt).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return triggered(writer, checkpoint, trigger)


def triggered(writer: DataStreamWriter, checkpoint: str, trigger: str | None) -> DataStreamWriter:
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


def start_commits(
    rows: DataFrame, path: str, checkpoint: str, trigger: str | None, by_date: bool, name: str
) -> StreamingQuery:
    """Write each batch as one commit, once, also if it is run again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        commits.commit_rows(batch, path, commits.stream_commit(batch, batch_id), by_date)

    return triggered(rows.writeStream.foreachBatch(write), checkpoint, trigger).queryName(name).start()


def start_history(
    transactions: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = DEFAULT_FORMAT,
    trigger: str | None = TRIGGER_INTERVAL,
    by_date: bool = False,
) -> StreamingQuery:
    """Keep every decoded transaction, late and unreadable ones included.

    A Parquet table is written batch by batch with commit records, so that appended and compacted
    rows belong to the same table; other formats keep their own log.
    """
    if by_date:
        transactions = with_event_date(transactions)
    if fmt == DEFAULT_FORMAT:
        return start_commits(transactions, path, checkpoint, trigger, by_date, "history")
    writer = table_writer(
        transactions, checkpoint, fmt, trigger, DATE_COLUMN if by_date else None
    )
    return writer.queryName("history").start(path)


def start_window_stats(
    transactions: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = DEFAULT_FORMAT,
    trigger: str | None = TRIGGER_INTERVAL,
    length: str = WINDOW_LENGTH,
    delay: str = WATERMARK_DELAY,
) -> StreamingQuery:
    """Write each window once, after the watermark has passed its end.

    State is one row per open window and partition, whatever the input rate.
    """
    stats = watermarked_window_stats(transactions, length, delay)
    return table_writer(stats, checkpoint, fmt, trigger).queryName("window_stats").start(path)


def start_scores(
    transactions: DataFrame,
    model: AnomalyModel,
    path: str,
    checkpoint: str,
    fmt: str = DEFAULT_FORMAT,
    trigger: str | None = TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Write a verdict per transaction."""
    report = score_report(transactions, model)
    return table_writer(report, checkpoint, fmt, trigger).queryName("scores").start(path)


def start_pipeline(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = DEFAULT_FORMAT,
    trigger: str | None = TRIGGER_INTERVAL,
    by_date: bool = True,
) -> list[StreamingQuery]:
    """History, by event date unless told otherwise, and window statistics from one message stream.

    They are two queries with two checkpoints on purpose: the stateless one
    keeps writing when the stateful one has to be restarted.
    """
    transactions = enriched(messages)
    return [
        start_history(
            transactions, f"{path}/history", f"{checkpoint}/history", fmt, trigger, by_date
        ),
        start_window_stats(
            transactions, f"{path}/window_stats", f"{checkpoint}/window_stats", fmt, trigger
        ),
    ]
