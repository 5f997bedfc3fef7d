from __future__ import annotations

import math

import pytest
from helpers import plan
from pyspark.sql import functions as F

from txsieve.operators import features, states
from txsieve.schemas import FEATURES
from txsieve.session import materialize


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("features") / "table")
    columns = [(F.rand(i) * 10 * (i + 1)).alias(name) for i, name in enumerate(FEATURES)]
    frame = spark.range(0, 500, 1, 4).select("id", *columns)
    frame = frame.withColumn("outputs_count", F.lit(3.0))
    frame = frame.withColumn("fee_rate", F.when(F.col("id") % 10 != 0, F.col("fee_rate")))
    frame = frame.withColumn(
        "size", F.when(F.col("id") == 7, F.lit(float("nan"))).otherwise(F.col("size"))
    )
    frame.write.parquet(path)
    return spark.read.parquet(path)


def test_complete_rows_drop_null_and_nan(table):
    kept = features.complete_rows(table)
    assert kept.count() == 500 - 50 - 1
    assert "IsNotNull(fee_rate)" in plan(kept)


def test_fit_transform(table):
    fitted = features.Preprocessor.fit(table)
    scaled = fitted.transform(features.complete_rows(table), "id").toPandas()
    clean = features.complete_rows(table).toPandas()
    for name, cap, mean, sd in zip(FEATURES, fitted.caps, fitted.means, fitted.sds):
        assert cap == pytest.approx(clean[name].quantile(0.99))
        clipped = clean[name].clip(upper=cap)
        assert mean == pytest.approx(clipped.mean())
        assert sd == pytest.approx(clipped.std(ddof=0), abs=1e-12)
        if sd > 1e-9:
            assert scaled[name].std(ddof=0) == pytest.approx(1.0)
            assert scaled[name].mean() == pytest.approx(0.0, abs=1e-9)
    assert (scaled["outputs_count"] == 0).all()


def test_transform_is_one_projection(table):
    fitted = features.Preprocessor.fit(table)
    text = plan(fitted.transform(table, "id"))
    assert "Join" not in text and "Exchange" not in text


def test_winsorize_keeps_null_and_lower_side(spark):
    frame = spark.createDataFrame([(-99.0,), (None,), (5.0,)], "a double")
    found = [row[0] for row in features.winsorize(frame, {"a": 1.0}).collect()]
    assert found == [-99.0, None, 1.0]


def test_approximate_caps(table):
    rows = features.complete_rows(table)
    exact = features.feature_caps(rows)
    for name, cap in features.feature_caps(rows, method="approx").items():
        assert math.isclose(cap, exact[name], rel_tol=0.05)
    with pytest.raises(ValueError):
        features.feature_caps(rows, method="guess")


def test_empty_input_is_an_error(table):
    with pytest.raises(ValueError):
        features.Preprocessor.fit(table.where("false"))


def test_maxabs(spark):
    frame = spark.createDataFrame([(-4.0, 0.0), (2.0, 0.0)], "a double, z double")
    found = [tuple(row) for row in features.maxabs_scale(frame, ["a", "z"]).collect()]
    assert found == [(-1.0, None), (0.5, None)]


def test_merged_states_equal_the_whole_table(spark, tmp_path):
    rows = spark.range(0, 60_000, 1, 6).select(
        (F.col("id") % 7).cast("string").alias("event_date"),
        *[(F.rand(k) * 1000 * (k + 1) + 1e6 * (F.col("id") % 7)).alias(name) for k, name in enumerate(FEATURES)],
    )
    rows = materialize(rows.withColumn("size", F.when(F.col("size") > 10, F.col("size"))), "states")
    path = str(tmp_path / "states")
    for k in (0, 3):
        part = F.col("event_date") <= "2"
        states.store_states(rows.where(part if k else ~part), path, commit=f"batch-{k}")
        states.store_states(rows.where(part if k else ~part), path, commit=f"batch-{k}")  # counts once
    merged = {r["feature"]: r for r in states.merged_states(states.read_states(spark, path)).collect()}
    clean = features.complete_rows(rows, FEATURES)
    for name in FEATURES:
        want = clean.agg(F.count(name), F.avg(name), F.stddev_pop(name), F.max(F.abs(name))).first()
        found = merged[name]
        assert found["n"] == want[0] and found["max_abs"] == want[3]
        assert found["mean"] == pytest.approx(want[1], rel=1e-12) and found["sd"] == pytest.approx(want[2], rel=1e-9)
        rank = clean.where(F.col(name) <= found["cap"]).count() / want[0]
        assert abs(rank - 0.99) < 0.002
