from __future__ import annotations

import datetime as dt

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from txsieve.operators import filters, monitoring, reports
from txsieve.operators.windows import window_stats
from txsieve.plans import catalog
from txsieve.sources import history

START = dt.datetime(2024, 1, 1)
VIEW = (
    "hash string, transaction_time timestamp_ntz, size int, fee bigint, inputs_count int, "
    "outputs_count int, input_value bigint, output_value bigint, fee_rate double, "
    "anomaly_score double, is_anomaly boolean"
)


def view(spark, *given):
    """Rows of (minutes after start, size, fee, score)."""
    return spark.createDataFrame(
        [
            (
                f"hash_number_{i}",
                None if minute is None else START + dt.timedelta(minutes=minute),
                size,
                fee,
                1,
                2,
                10,
                20,
                fee / size if size else None,
                score,
                score > 1.0,
            )
            for i, (minute, size, fee, score) in enumerate(given)
        ],
        VIEW,
    )


def test_window_stats_edges(spark):
    given = view(spark, (0, 1, 10, 0.0), (9, 3, 30, 0.0), (10, 0, 5, 0.0), (None, 1, 1, 0.0))
    found = rows(window_stats(given))
    assert [row[2] for row in found] == [2, 1]
    assert found[0][3:] == (20.0, 10.0, 2.0, 1.0, 2.0, 20, 40)
    assert found[1][4] is None  # size 0 has no fee rate
    assert found[0][1] - found[0][0] == dt.timedelta(minutes=10)


def test_kpi_cards(spark):
    given = view(spark, (0, 10, 1234, 2.0), (1, 30, 30, 0.0))
    card = reports.kpi_cards(given).first().asDict()
    assert card["total_transactions"] == 2 and card["total_anomalies"] == 1
    assert card["avg_fee_rate_text"] == "62.20"
    only = reports.kpi_cards(given, only_anomalies=True).first()
    assert only["total_transactions"] == only["total_anomalies"] == 1
    empty = reports.kpi_cards(given.where("false")).first()
    assert empty["total_transactions"] == 0 and empty["avg_fee_rate"] is None


def test_hourly(spark):
    given = view(spark, (0, 1, 1, 2.0), (59, 1, 1, 0.0), (60, 1, 1, 0.0))
    assert [row["count"] for row in reports.hourly_counts(given).collect()] == [1, 1, 1]
    stacked = [tuple(row)[1:] for row in reports.hourly_stacked(given).orderBy("hour").collect()]
    assert stacked == [(1, 1, 0, 2), (1, 0, 0, 1)]


def test_histogram_covers_every_score(spark):
    scores = [0.0, 0.1, 0.5, 0.99, 1.0, 1.0]
    given = view(spark, *[(0, 1, 1, score) for score in scores])
    found = {row["bin"]: row for row in reports.score_histogram(given, bins=10).collect()}
    assert {bin_no: row["count"] for bin_no, row in found.items()} == {0: 1, 1: 1, 5: 1, 9: 3}
    assert found[9]["bin_end"] == pytest.approx(1.0)
    single = reports.score_histogram(view(spark, (0, 1, 1, 0.3), (0, 1, 1, 0.3))).collect()
    assert [(row["bin"], row["count"]) for row in single] == [(0, 2)]


def test_recent_table_is_a_top_k(spark):
    given = view(spark, *[(i, 1000 + i, 5, 0.0) for i in range(25)], (30, 1, 7, 3.0))
    table = reports.recent_table(given)
    assert "TakeOrderedAndProject" in plan(table)
    found = table.collect()
    assert len(found) == 10
    assert tuple(found[0]) == (
        "2024-01-01 00:30:00",
        "hash_numbe...",
        "1",
        "7",
        "7.00",
        "3.00",
        "Anomaly",
    )
    assert found[1]["size"] == "1,024"
    assert reports.recent_table(given, only_anomalies=True).count() == 1


def test_recent_table_unscored_shows_every_one_of_the_newest_rows(spark, tmp_path):
    """No row is left out by its fee or its score, and only a missing feature leaves a row unscored."""
    events = spark.range(500).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(1_700_000_000 + F.col("id")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.lit("view").alias("event_type"),
        (F.col("id") / 100.0).alias("value"),
        F.concat(F.lit('{"k": '), F.col("id") % 50, F.lit("}")).alias("props"),
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    found = catalog.QUERIES["recent_table_unscored"](spark, str(tmp_path)).collect()
    assert len(found) == len({row["time"] for row in found}) == 400
    assert {row["size"] for row in found if row["status"] == "Unscored"} == {"0"}
    assert sum(row["status"] == "Unscored" for row in found) == 8


def test_model_metrics(spark):
    given = view(spark, (0, 10, 100, 2.0), (0, 20, 100, 0.0), (0, 0, 50, 0.0))
    found = reports.model_metrics(given).first().asDict()
    assert found["num_transactions"] == 3 and found["num_anomalies"] == 1
    assert found["anomaly_percentage"] == pytest.approx(100 / 3)
    assert (found["avg_normal_fee"], found["avg_anomaly_fee"]) == (75.0, 100.0)
    assert (found["avg_normal_size"], found["avg_anomaly_size"]) == (10.0, 10.0)
    assert (found["avg_normal_fee_rate"], found["avg_anomaly_fee_rate"]) == (5.0, 10.0)


def test_time_and_size_filters(spark):
    given = view(spark, (0, 0, 1, 0.0), (60, 100, 1, 0.0), (180, 10000, 1, 0.0), (181, 10001, 1, 0.0))
    now = START + dt.timedelta(minutes=180)
    assert filters.filter_time_range(given, "2h", now).count() == 3
    assert filters.filter_time_range(given, "2h", "latest").count() == 2
    assert filters.filter_time_range(given, "all").count() == 4
    assert filters.filter_time_range(given, "24h").count() == 0  # nothing is recent today
    assert filters.filter_size_range(given).count() == 3
    kept = filters.filtered_view(given, "all", (100, 10000), threshold=-1.0)
    assert kept.count() == 2 and kept.where("is_anomaly").count() == 2
    assert filters.anomalies_only(given, False).count() == 4
    with pytest.raises(ValueError):
        filters.filter_time_range(given, "2h", "soon")


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "history")
    given = view(spark, (0, 5, 1, 0.0), (60 * 48, 5, 1, 0.0))
    history.append_history(given, path, by_date=True)
    stored = history.read_history(spark, path)
    now = START + dt.timedelta(days=2)
    kept = filters.filtered_view(stored, "24h", (1, 10), now=now).select("hash")
    text = plan(kept)
    assert "GreaterThanOrEqual(transaction_time" in text
    assert "GreaterThanOrEqual(size,1)" in text
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "fee" not in text.split("ReadSchema")[1].split("\n")[0]
    assert kept.count() == 1
    latest = filters.filter_time_range(stored, "24h", "latest")
    assert latest.count() == 1


def test_counters(spark):
    given = view(spark, (0, 1, 1, 2.0), (5, 1, 1, 0.25), (5, 1, 1, 0.5))
    assert rows(monitoring.processed_counter(given)) == [("anomalous", 1), ("normal", 2)]
    assert monitoring.latest_score(given).first()[0] == 0.5  # the later hash of the same time
    unscored = given.withColumn("anomaly_score", F.when(F.col("fee") > 1, F.col("anomaly_score")))
    assert monitoring.prediction_errors(unscored).first()[0] == 3


def test_latency(spark):
    seen = spark.createDataFrame(
        [("a", 0.1), ("a", 0.6), ("b", 20.0), ("b", None)], "endpoint string, seconds double"
    )
    found = monitoring.latency_histogram(seen, "seconds").collect()
    assert [(row["le"], row["bucket_count"]) for row in found] == [
        ("0.1", 1),
        ("0.5", 1),
        ("1.0", 2),
        ("2.0", 2),
        ("5.0", 2),
        ("10.0", 2),
        ("+Inf", 3),
    ]
    assert {(row["count"], round(row["sum"], 9)) for row in found} == {(3, 20.7)}
    assert rows(monitoring.latency_summary(seen, "seconds")) == [("a", 2, 0.7), ("b", 1, 20.0)]


def test_lag_counts_untouched_partitions_in_full(spark):
    offsets = spark.createDataFrame(
        [(0, 5, True), (0, 6, True), (0, 9, False), (1, 3, False), (1, 4, False)],
        "partition int, offset bigint, done boolean",
    )
    assert rows(monitoring.consumer_lag(offsets, F.col("done"))) == [(0, 3), (1, 2)]


def test_table_bytes(spark, tmp_path):
    path = tmp_path / "table"
    spark.range(1000).repartition(3).write.parquet(str(path))
    expected = sum(file.stat().st_size for file in path.glob("*.parquet"))
    assert tuple(monitoring.table_bytes(spark, str(path)).first()) == (expected, 3)
    text = tmp_path / "text"
    spark.range(100).coalesce(2).write.csv(str(text))
    expected = sum(file.stat().st_size for file in text.glob("part-*"))
    assert monitoring.table_bytes(spark, str(text)).first()["bytes"] == expected
