from __future__ import annotations

from helpers import plan, rows
from pyspark.sql import functions as F

from txsieve.operators import joins


def test_hot_key_with_many_copies(spark):
    """A third of both sides shares one key: N rows come out, not N squared."""
    left = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("hash"),
        F.col("id").alias("fee"),
    )
    scores = left.select(
        "hash",
        (F.col("fee") / 3000).alias("anomaly_score"),
        (F.col("fee") > 2990).alias("is_anomaly"),
    )
    joined = joins.attach_scores(left, scores, salts=4)
    assert joined.count() == 3000
    assert joined.columns == ["hash", "fee", "anomaly_score", "is_anomaly"]
    hot = joined.where("hash = 'hot'")
    assert hot.count() == 1000
    assert hot.select("anomaly_score", "is_anomaly").distinct().collect() == [(2997 / 3000, True)]
    cold = joined.where("hash = '2'").first()
    assert (cold["fee"], cold["anomaly_score"]) == (2, 2 / 3000)


def test_inner_semantics_and_null_keys(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "hash string, fee int")
    scores = spark.createDataFrame(
        [("a", 0.5, False), ("z", 0.1, True), (None, 0.9, True)],
        "hash string, anomaly_score double, is_anomaly boolean",
    )
    assert rows(joins.attach_scores(left, scores)) == [("a", 1, 0.5, False)]
    assert joins.attach_scores(left.where("false"), scores).count() == 0


def test_no_job_and_a_spread_hot_key_after_a_shuffle(spark):
    left = spark.range(1000).select(F.lit("hot").alias("hash"), F.col("id").alias("fee"))
    left = left.repartition(4, "hash")  # all in one task
    scores = spark.createDataFrame(
        [("hot", 0.5, False)], "hash string, anomaly_score double, is_anomaly boolean"
    )
    spark.sparkContext.setJobGroup("attach", "")
    joined = joins.attach_scores(left, scores, salts=4)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("attach")
    spark.sparkContext.setJobGroup(None, None)
    assert joined.count() == 1000
    row = F.xxhash64("hash", "fee")
    parts = left.groupBy(F.pmod(row, F.lit(4))).count().collect()
    assert len(parts) == 4 and all(150 < part["count"] < 350 for part in parts)


def test_no_cross_join(spark):
    left = spark.createDataFrame([("a", 1)], "hash string, fee int")
    scores = spark.createDataFrame(
        [("a", 0.5, False)], "hash string, anomaly_score double, is_anomaly boolean"
    )
    text = plan(joins.attach_scores(left, scores))
    assert "NestedLoop" not in text and "Cartesian" not in text
