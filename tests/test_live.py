"""Commit records, claims, late rows, newest models, observed metrics."""

from __future__ import annotations

import threading

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from txsieve.operators import records
from txsieve.operators.features import Preprocessor
from txsieve.operators.iforest import AnomalyModel
from txsieve.plans import catalog
from txsieve.plans import fixtures as fx
from txsieve.schemas import FEATURES
from txsieve.sources import commits, history, messages, registry
from txsieve.streaming import live, pipelines, progress


def tx(spark, *ids, day=1):
    return spark.createDataFrame(
        [(f"h{i}", i, f"2024-01-{day:02d} 00:00:00") for i in ids], "hash string, fee bigint, transaction_time string"
    ).withColumn("transaction_time", F.to_timestamp("transaction_time"))


def hashes(df):
    return sorted(r["hash"] for r in df.collect())


def test_commits_of_all_kinds_are_one_table(spark, tmp_path):
    path = str(tmp_path / "t")
    history.append_history(tx(spark, 1, 2), path, by_date=True)
    history.append_history(tx(spark, 3, day=2), path)
    assert hashes(history.read_history(spark, path)) == ["h1", "h2", "h3"]
    commits.compact(spark, path, by_date=True)
    history.append_history(tx(spark, 4), path)
    found = history.read_history(spark, path)
    assert hashes(found) == ["h1", "h2", "h3", "h4"]
    assert len(commits.live_commits(spark, path)) == 2
    dates = {r["hash"]: str(r["event_date"]) for r in found.collect()}
    assert dates["h3"] == "2024-01-02" and dates["h4"] == "2024-01-01"


def test_a_batch_is_committed_once(spark, tmp_path):
    path = str(tmp_path / "t")
    commits.commit_rows(tx(spark, 1), path, "stream-a-0")
    commits.commit_rows(tx(spark, 9), path, "stream-a-0")  # run again after its record
    tx(spark, 7).write.parquet(f"{path}/_commit=stream-a-1")  # files of an attempt that died before its record
    assert hashes(history.read_history(spark, path)) == ["h1"]
    commits.commit_rows(tx(spark, 2), path, "stream-a-1")
    assert hashes(history.read_history(spark, path)) == ["h1", "h2"]


def test_files_without_records_are_not_lost(spark, tmp_path):
    path = str(tmp_path / "t")
    tx(spark, 1).write.parquet(path)
    assert hashes(history.read_history(spark, path)) == ["h1"]
    with pytest.raises(ValueError, match="without commit records"):
        history.append_history(tx(spark, 2), path)
    assert hashes(history.read_history(spark, path)) == ["h1"]


def test_rows_appended_to_a_streamed_table_are_read(spark, tmp_path):
    folder, out = str(tmp_path / "m"), str(tmp_path / "o")
    flat = fx.event_transactions(spark, "/root/testdata/sf0.001").limit(50)
    messages.write_message_files(records.to_messages(flat), folder)
    stream = pipelines.enriched(messages.file_stream(spark, folder))
    pipelines.start_history(stream, f"{out}/t", f"{out}/c", trigger=None).awaitTermination()
    stored = history.read_history(spark, f"{out}/t")
    history.append_history(stored.limit(20), f"{out}/t")
    assert history.read_history(spark, f"{out}/t").count() == 70


def small_model(offset):
    width = len(FEATURES)
    plain = Preprocessor(FEATURES, [None] * width, [0.0] * width, [1.0] * width)
    nodes = [(0, 0, 2, 50.0, 1, 2, 4, 0), (0, 1, None, None, None, None, 3, 1), (0, 2, None, None, None, None, 1, 1)]
    return AnomalyModel(plain, nodes, 1, 2, 0, 0.01, offset)


def test_concurrent_saves_get_their_own_versions(spark, tmp_path):
    path, found = str(tmp_path / "models"), []
    threads = [
        threading.Thread(target=lambda k=k: found.append((registry.save_model(spark, path, small_model(k / 10)), k)))
        for k in range(3)
    ]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(version for version, _ in found) == [1, 2, 3]
    for version, k in found:
        assert registry.load_model(spark, path, version).offset == k / 10
    assert not commits.claim(spark, f"{path}/claims/version=2")


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landed"))
    events = fx.slices(spark.read.parquet(f"{sf_dir}/events.parquet"), 5, displaced=True)
    fx.land_slices(events, folder, range(5))
    return folder


def stream_of(spark, sf_dir, folder):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return messages.file_stream(spark, folder, "parquet", schema, maxFilesPerTrigger="1")


def test_a_batch_is_one_slice_of_several_files(spark, tmp_path):
    """A large slice is dealt to several files; a short or empty one makes a batch of its own all the same."""
    sizes = {0: 1000, 1: 2, 2: 0, 3: 600}
    events = spark.range(1000).withColumn("slice", F.lit(0))
    for k, n in list(sizes.items())[1:]:
        events = events.unionByName(spark.range(n).withColumn("slice", F.lit(k)))
    files = fx.files_a_slice(events, 250)
    assert files == 4
    fx.land_slices(events.withColumn("of", F.col("slice")), f"{tmp_path}/landed", range(4), files)
    held = spark.read.parquet(f"{tmp_path}/landed").groupBy(F.input_file_name().alias("file"), "of").count()
    assert max(row["count"] for row in held.collect()) < 500

    stream = messages.file_stream(spark, f"{tmp_path}/landed", "parquet", "id long, of int", maxFilesPerTrigger=str(files))
    batches = {}

    def write(batch, batch_id):
        batches[batch_id] = {row["of"]: row["count"] for row in batch.groupBy("of").count().collect()}

    pipelines.triggered(stream.writeStream.foreachBatch(write), f"{tmp_path}/c", None).start().awaitTermination()
    assert batches == {k: {k: n} if n else {} for k, n in sizes.items()}


def test_the_offset_is_found_without_scoring_again(spark, monkeypatch):
    scanned = []

    def quantiles(df, columns, q):
        scanned.append(plan(df))
        return {"raw": 0.5}

    monkeypatch.setattr(catalog, "exact_quantiles", quantiles)
    plain = Preprocessor(["fee", "size"], [None] * 2, [0.0] * 2, [1.0] * 2)
    model = AnomalyModel(plain, [(0, 0, None, None, None, None, 4, 0)], 1, 4, 0, 0.1)
    rows_of_two = spark.range(5).select(F.col("id").alias("fee"), F.col("id").alias("size"))
    assert catalog._score_quantile(rows_of_two, model, 0.9) == 0.5
    assert "ArrowEvalPython" not in scanned[0]


def test_late_rows_are_those_that_spark_drops(spark, sf_dir, landed, tmp_path):
    stream = pipelines.enriched(records.to_messages(fx.as_transactions(stream_of(spark, sf_dir, landed))))
    stats = pipelines.start_window_stats(stream, f"{tmp_path}/s", f"{tmp_path}/sc", trigger=None)
    stats.awaitTermination()
    dropped = {p["batchId"]: progress.rows_dropped_late(p) for p in stats.recentProgress}
    live.start_late_rows(stream, f"{tmp_path}/l", f"{tmp_path}/lc", trigger=None).awaitTermination()
    late = live.read_late_rows(spark, f"{tmp_path}/l")
    # Spark counts rows after the partial aggregation: one a window and task
    groups = late.groupBy("batch").agg(F.count_distinct("window_end")).collect()
    assert dict(map(tuple, groups)) == {batch: n for batch, n in dropped.items() if n}
    assert sum(dropped.values()) > 20
    counted = spark.read.parquet(f"{tmp_path}/s").agg(F.sum("transaction_count")).first()[0]
    assert counted + late.count() <= 1000
    before = rows(late.drop("processing_time"))
    live.start_late_rows(stream, f"{tmp_path}/l", f"{tmp_path}/lc", trigger=None).awaitTermination()
    assert rows(live.read_late_rows(spark, f"{tmp_path}/l").drop("processing_time")) == before


def test_batch_metrics_are_stored_once_a_batch(spark, sf_dir, landed, tmp_path):
    scored = fx.as_transactions(stream_of(spark, sf_dir, landed)).withColumn("is_anomaly", F.col("fee") > 5000)
    listener = live.BatchMetrics(spark, f"{tmp_path}/m", "watched")
    spark.streams.addListener(listener)
    try:
        observed = scored.observe("seen", *live.observed_columns(F.col("fee") / 10_000))
        pipelines.start_commits(observed, f"{tmp_path}/t", f"{tmp_path}/c", None, False, "watched").awaitTermination()
        listener.wait()
    finally:
        spark.streams.removeListener(listener)
    stored = live.read_batch_metrics(spark, f"{tmp_path}/m").orderBy("batch").collect()
    assert [r["batch"] for r in stored] == [0, 1, 2, 3, 4]
    assert sum(r["rows"] for r in stored) == 1000 and all(r["seconds"] > 0 and r["behind"] == 0 for r in stored)
    table = history.read_history(spark, f"{tmp_path}/t")
    assert sum(r["observed"]["anomalous"] for r in stored) == table.where("is_anomaly").count()
    assert all(r["observed"]["normal"] + r["observed"]["anomalous"] == r["rows"] for r in stored)


def test_the_newest_model_scores_and_reruns_change_nothing(spark, sf_dir, landed, tmp_path):
    stream = fx.as_transactions(stream_of(spark, sf_dir, landed))
    registry.save_model(spark, f"{tmp_path}/m", small_model(0.2))

    def run():
        live.start_newest_scores(stream, f"{tmp_path}/m", f"{tmp_path}/t", f"{tmp_path}/c", trigger=None).awaitTermination()
        return history.read_history(spark, f"{tmp_path}/t")

    first = rows(run())
    assert len(first) == 1000 and {r[-1] for r in first} == {1}
    registry.save_model(spark, f"{tmp_path}/m", small_model(0.9))
    assert rows(run()) == first
