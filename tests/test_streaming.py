from __future__ import annotations

import datetime as dt

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from txsieve.operators import records
from txsieve.operators.filters import filter_time_range
from txsieve.operators.windows import window_stats
from txsieve.plans import jobs
from txsieve.sources import messages
from txsieve.streaming import pipelines, progress

EPOCH = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def send(spark, folder, *minutes):
    start = int(EPOCH.timestamp())
    flat = spark.createDataFrame(
        [(f"h{m}", start + 60 * m, 10, 40, 100 + m, 1, 2, 5, 6) for m in minutes],
        "hash string, time bigint, size int, weight int, fee bigint, inputs_count int, "
        "outputs_count int, input_value bigint, output_value bigint",
    )
    messages.write_message_files(records.to_messages(flat).coalesce(1), folder)


def run(spark, folder, out):
    stream = messages.file_stream(spark, folder)
    started = pipelines.start_pipeline(stream, f"{out}/tables", f"{out}/checkpoints", trigger=None)
    for query in started:
        query.awaitTermination()
    return started


def test_stream_equals_batch_on_closed_windows_and_restarts(spark, tmp_path):
    folder, out = str(tmp_path / "messages"), str(tmp_path / "out")
    send(spark, folder, 0, 3, 12, 25, 41)
    run(spark, folder, out)
    history = spark.read.parquet(f"{out}/tables/history")
    assert history.count() == 5
    assert {"fee_rate", "fee_per_weight", "processing_time"} <= set(history.columns)

    stats = spark.read.parquet(f"{out}/tables/window_stats")
    closed = window_stats(history).where(
        F.col("window_end") <= F.lit(EPOCH + dt.timedelta(minutes=31))
    )
    assert rows(stats) == rows(closed)
    assert stats.count() == 3

    run(spark, folder, out)  # nothing new: nothing is written twice
    assert spark.read.parquet(f"{out}/tables/history").count() == 5
    assert spark.read.parquet(f"{out}/tables/window_stats").count() == 3

    send(spark, folder, 5, 60)  # minute 5 is late, minute 60 closes more windows
    queries = run(spark, folder, out)
    assert spark.read.parquet(f"{out}/tables/history").count() == 7
    after = spark.read.parquet(f"{out}/tables/window_stats")
    assert after.count() == 4 and after.agg(F.sum("transaction_count")).first()[0] == 5
    assert all(progress.processing_seconds(p) > 0 for p in queries[1].recentProgress)
    dropped = [progress.rows_dropped_late(p) for p in queries[1].recentProgress]
    assert sum(dropped) == 1


def test_unreadable_messages_stay_in_the_history(spark, tmp_path):
    folder, out = tmp_path / "messages", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.txt").write_text('{"hash":"ok","time":60}\nnot json\n')
    run(spark, str(folder), out)
    assert spark.read.parquet(f"{out}/tables/history").count() == 2


def test_impossible_times_and_overflows_do_not_end_the_stream(spark, tmp_path):
    folder, out = tmp_path / "messages", str(tmp_path / "out")
    folder.mkdir()
    start, huge = int(EPOCH.timestamp()), 9_000_000_000_000_000_000
    lines = [
        f'{{"hash":"far","time":{huge},"fee":1,"size":1}}',
        f'{{"hash":"a","time":{start},"input_value":{huge},"output_value":1}}',
        f'{{"hash":"b","time":{start + 1},"input_value":{huge},"output_value":2}}',
        f'{{"hash":"c","time":{start + 6000}}}',
    ]
    (folder / "a.txt").write_text("\n".join(lines))
    run(spark, str(folder), out)
    run(spark, str(folder), out)
    history = spark.read.parquet(f"{out}/tables/history")
    assert history.count() == 4
    assert history.where("transaction_time is null").select("hash").collect() == [("far",)]
    stats = spark.read.parquet(f"{out}/tables/window_stats")
    found = stats.select("transaction_count", "total_input_value", "total_output_value").collect()
    assert found == [(2, None, 3)]


def test_pipeline_history_is_pruned_by_date(spark, tmp_path):
    folder, out = str(tmp_path / "messages"), str(tmp_path / "out")
    send(spark, folder, 0, 60 * 24, 60 * 24 + 30)
    run(spark, folder, out)
    history = spark.read.parquet(f"{out}/tables/history")
    kept = filter_time_range(history, "1h", now="latest")
    assert {row["hash"] for row in kept.collect()} == {"h1440", "h1470"}
    assert "PartitionFilters: [isnotnull(event_date" in plan(kept)


def test_history_partitioned_by_date(spark, tmp_path):
    folder, out = str(tmp_path / "messages"), str(tmp_path / "out")
    send(spark, folder, 0, 60 * 24)
    tx = pipelines.enriched(messages.file_stream(spark, folder))
    pipelines.start_history(
        tx, f"{out}/t", f"{out}/c", trigger=None, by_date=True
    ).awaitTermination()
    assert spark.read.parquet(f"{out}/t").select("event_date").distinct().count() == 2


def test_interval_trigger_keeps_running_until_stopped(spark, tmp_path):
    folder, out = str(tmp_path / "messages"), str(tmp_path / "out")
    send(spark, folder, 0)
    tx = pipelines.enriched(messages.file_stream(spark, folder))
    query = pipelines.start_history(tx, f"{out}/t", f"{out}/c", trigger="1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert spark.read.parquet(f"{out}/t").count() == 1


def test_stream_job_waits_for_its_queries(spark, tmp_path):
    folder, out = str(tmp_path / "messages"), str(tmp_path / "out")
    send(spark, folder, 0, 1, 2)
    stream = messages.file_stream(spark, folder)
    jobs.stream(stream, f"{out}/t", f"{out}/c", trigger=None)
    for query in spark.streams.active:
        query.awaitTermination()
    assert spark.read.parquet(f"{out}/t/history").count() == 3


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        messages.kafka_stream(spark, "host:1", "topic")


def test_lag_from_progress():
    report = {
        "sources": [
            {"endOffset": {"t": {"0": 5, "1": 7}}, "latestOffset": {"t": {"0": 9, "1": 7}}},
            {"endOffset": '{"t": {"0": 1}}', "latestOffset": '{"t": {"0": 3, "1": 2}}'},
            {"endOffset": "null", "latestOffset": None},
            {"endOffset": {"logOffset": 3}, "latestOffset": None},
        ]
    }
    assert progress.messages_behind(report) == 4 + 4
