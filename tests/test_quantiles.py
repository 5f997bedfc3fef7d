from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txsieve.operators import quantiles
from txsieve.operators.quantiles import approximate_quantiles, exact_quantiles


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = np.random.default_rng(5)
    n = 20_000
    heavy = np.where(rng.random(n) < 1 / 3, 7.0, rng.lognormal(3, 2, n))
    columns = {
        "heavy": heavy,
        "few": rng.integers(0, 4, n).astype(float),
        "smooth": rng.normal(size=n),
        "constant": np.full(n, 2.0),
        "steps": np.where(rng.random(n) < 0.9, 0.0, rng.random(n)),
    }
    path = str(tmp_path_factory.mktemp("quantiles") / "table")
    pdf = __import__("pandas").DataFrame(columns)
    frame = spark.createDataFrame(pdf).withColumn("nothing", F.lit(None).cast("double"))
    frame = frame.withColumn("gaps", F.when(F.rand(3) < 0.8, F.col("smooth")))
    frame.repartition(6).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("rankable, sample", [(10, quantiles.SAMPLE_ROWS), (700, 300)])
@pytest.mark.parametrize("q", [0.0, 0.335, 0.99, 1.0])
def test_equals_numpy_however_many_rounds(table, q, rankable, sample, monkeypatch):
    monkeypatch.setattr(quantiles, "SAMPLE_ROWS", sample)
    pdf = table.toPandas()
    found = exact_quantiles(table, table.columns, q, rankable=rankable)
    for name in table.columns:
        values = pdf[name].dropna().astype(float)
        if values.empty:
            assert found[name] is None
        else:
            assert found[name] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-12)


def test_few_rows(table):
    found = exact_quantiles(table, ["smooth", "nothing"], 0.9)
    assert found["smooth"] == pytest.approx(np.quantile(table.toPandas()["smooth"], 0.9))
    assert found["nothing"] is None


def test_rounds_are_few(table, monkeypatch):
    scans = []
    narrow = quantiles._narrow_by_scan
    monkeypatch.setattr(
        quantiles, "_narrow_by_scan", lambda *args: (scans.append(1), narrow(*args))[1]
    )
    monkeypatch.setattr(quantiles, "SAMPLE_ROWS", 2000)
    exact_quantiles(table, ["smooth", "heavy"], 0.99, rankable=50)
    assert len(scans) <= 4


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    values=st.lists(st.integers(-3, 3) | st.floats(-1e6, 1e6), min_size=1, max_size=40),
    q=st.floats(0, 1),
)
def test_small_inputs(spark, values, q):
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    found = exact_quantiles(frame, ["v"], q, rankable=2)["v"]
    assert math.isclose(found, np.quantile(values, q), rel_tol=1e-9, abs_tol=1e-6)


def test_wrong_guess_still_ends_right(table, monkeypatch):
    """A sample that proposes useless cut points costs scans, not correctness."""
    monkeypatch.setattr(
        quantiles._Search,
        "propose",
        lambda self, grid, share: setattr(self, "cuts", (grid[0], grid[5]) if grid else ()),
    )
    values = table.toPandas()["smooth"]
    found = exact_quantiles(table, ["smooth"], 0.02, rankable=19_000)["smooth"]
    assert found == pytest.approx(np.quantile(values, 0.02), rel=1e-12)


def test_approximate_mode_is_close(table):
    found = approximate_quantiles(table, ["smooth", "nothing", "gaps"], 0.99)
    assert found["nothing"] is None and found["gaps"] is not None
    found = found["smooth"]
    values = np.sort(table.toPandas()["smooth"])
    rank = np.searchsorted(values, found) / len(values)
    assert abs(rank - 0.99) < 0.001
