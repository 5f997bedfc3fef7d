from __future__ import annotations

import numpy as np
import pytest
from helpers import rows, transactions
from pyspark.sql import functions as F

from txsieve.operators import enrich, iforest
from txsieve.operators.features import Preprocessor, complete_rows
from txsieve.operators.iforest import average_path, fit_isolation_forest, sample_trees
from txsieve.operators.scoring import score_report
from txsieve.plans import fixtures, jobs
from txsieve.schemas import FEATURES
from txsieve.session import materialize
from txsieve.sources import exports, history, messages, registry, runlog
from txsieve.streaming import pipelines


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return materialize(fixtures.identified_transactions(spark, sf_dir), "tests")


@pytest.fixture(scope="module")
def fitted(table):
    return fit_isolation_forest(table, keep=("hash",))


def test_average_path():
    assert [average_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert average_path(256) == pytest.approx(10.24477, abs=1e-5)


def test_flagged_share_and_score_range(table, fitted):
    model, scored = fitted
    total = complete_rows(table).count()
    assert scored.count() == total == model.trained_rows
    values = np.array([row[0] for row in scored.select("anomaly_score").collect()]) + model.offset
    assert ((values > 0) & (values < 1)).all()
    flagged = scored.where("is_anomaly").count()
    assert abs(flagged - 0.01 * total) <= 1
    assert model.offset == pytest.approx(np.quantile(values, 0.99))


def test_nodes_form_full_trees(fitted):
    model, _ = fitted
    by_tree: dict[int, dict[int, tuple]] = {}
    for node in model.nodes:
        by_tree.setdefault(node[0], {})[node[1]] = node
    assert sorted(by_tree) == list(range(100))
    for nodes in by_tree.values():
        assert nodes[0][6] == 256
        for _, _, feature, threshold, left, right, n, depth in nodes.values():
            assert depth <= 8
            if feature is None:
                assert left is None and right is None and threshold is None
            else:
                assert nodes[left][6] + nodes[right][6] == n
                assert min(nodes[left][6], nodes[right][6]) >= 1


def test_walk_equals_plain_descent(table, fitted):
    """Path lengths from the dense arrays against following the node table."""
    model, _ = fitted
    scaled = model.preprocessor.transform(complete_rows(table)).limit(50).toPandas()
    points = scaled[FEATURES].to_numpy()
    children = {(node[0], node[1]): node for node in model.nodes}

    def path(tree: int, point: np.ndarray) -> float:
        node = children[tree, 0]
        while node[2] is not None:
            node = children[tree, node[5] if point[node[2]] > node[3] else node[4]]
        return node[7] + average_path(node[6])

    expected = [
        2 ** (-np.mean([path(tree, point) for tree in range(100)]) / average_path(256))
        for point in points
    ]
    forest = iforest.Forest.from_nodes(model.nodes, 100, 256)
    assert forest.score(list(points.T)) == pytest.approx(expected)


def test_a_walk_is_as_long_as_the_deepest_leaf():
    nodes = [
        (0, 0, 0, 1.0, 1, 2, 100, 0), (0, 1, None, None, None, None, 90, 1), (0, 2, 1, 5.0, 5, 6, 10, 1),
        (0, 5, None, None, None, None, 8, 2), (0, 6, None, None, None, None, 2, 2),
    ]
    forest = iforest.Forest.from_nodes(nodes, 1, 256)
    assert forest.depth == 2
    found = forest.score([np.array([0.0, 2.0, 2.0]), np.array([9.0, 5.0, 6.0])])
    paths = [1 + average_path(90), 2 + average_path(8), 2 + average_path(2)]
    assert list(found) == list(np.exp2(-np.array(paths) / average_path(256)))
    assert iforest.Forest.from_nodes([(0, 0, None, None, None, None, 4, 0)], 1, 4).score([np.zeros(1)]).shape == (1,)


def test_same_seed_same_model_for_any_split(spark, table, fitted, tmp_path):
    model, _ = fitted
    again, _ = fit_isolation_forest(table.repartition(7))
    assert again.nodes == model.nodes and again.offset == pytest.approx(model.offset)
    other, _ = fit_isolation_forest(table, seed=7)
    assert other.nodes != model.nodes


def test_sample_is_uniform_over_copies(spark):
    """Copies of one transaction take their share of every sample, not more or less."""
    copies = spark.range(0, 9000, 1, 8).select(
        F.col("id").alias("row_id"), F.when(F.col("id") < 3000, 1.0).otherwise(2.0).alias("v")
    )
    sample, everything = sample_trees(copies, ["v"], 9000, 20, 64, 42)
    counts = sample.groupBy("tree_id").agg(F.count("*").alias("n"), F.count_if(F.col("v") == 1))
    found = counts.collect()
    assert not everything
    assert len(found) == 20 and all(row[1] == 64 for row in found)
    share = sum(row[2] for row in found) / (20 * 64)
    assert abs(share - 1 / 3) < 0.06


def test_offers_follow_the_binomial_law(spark):
    drawn = spark.range(0, 40000, 1, 8).select(iforest._uniform(F.md5(F.col("id").cast("string"))).alias("u"))
    offers = drawn.select(iforest._binomial(F.col("u"), 100, 0.02).alias("k"))
    row = offers.agg(F.avg("k"), F.var_pop("k"), F.min("k")).first()
    assert abs(row[0] - 2) < 0.03 and abs(row[1] - 1.96) < 0.08 and row[2] == 0


def test_offered_trees_are_uniform_sets(spark):
    ids = spark.range(0, 20000, 1, 8).select(F.col("id").cast("string").alias("row"))
    trees = iforest._distinct_trees(F.lit(2), F.col("row"), 5, 42)
    sets = ids.select(F.array_sort(trees).alias("t")).groupBy("t").count().collect()
    assert len(sets) == 10 and all(abs(r["count"] / 2000 - 1) < 0.1 for r in sets)
    everything = ids.limit(50).select(F.array_sort(iforest._distinct_trees(F.lit(5), F.col("row"), 5, 42)))
    assert {tuple(r[0]) for r in everything.collect()} == {(0, 1, 2, 3, 4)}


def test_rows_without_identity_are_an_error(spark, table):
    nameless = table.withColumn("row_id", F.lit(None).cast("bigint"))
    with pytest.raises(ValueError, match="row_id"):
        fit_isolation_forest(nameless)


def test_copied_and_compacted_history_gives_the_same_forest(spark, sf_dir, tmp_path):
    tx = fixtures.identified_transactions(spark, sf_dir)
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    history.append_history(tx.repartition(5), first)
    history.append_history(spark.read.parquet(first).coalesce(1), second)
    models = [
        fit_isolation_forest(history.read_history(spark, path, row_id=True), n_trees=5)[0]
        for path in (first, second)
    ]
    assert models[0].nodes == models[1].nodes


def test_sample_without_replacement(spark):
    numbers = spark.range(0, 5000, 1, 8).select(F.col("id").alias("row_id"), F.col("id").alias("v"))
    sample, _ = sample_trees(numbers, ["v"], 5000, 10, 100, 1)
    assert sample.select("tree_id", "v").distinct().count() == 1000


def test_short_sample_is_widened(spark, table, monkeypatch):
    monkeypatch.setattr(iforest, "OVERSAMPLE", 0.5)
    clean = complete_rows(table)
    scaled = Preprocessor.fit(clean).transform(clean, "row_id")
    nodes, psi = iforest.grow_forest(scaled, FEATURES, clean.count(), n_trees=5)
    assert psi == 256 and all(node[6] == 256 for node in nodes if node[1] == 0)


def test_planted_outliers_rank_on_top(spark):
    noise = [(F.rand(i) + 1).alias(name) for i, name in enumerate(FEATURES)]
    frame = materialize(spark.range(0, 3000, 1, 4).select(F.col("id").alias("row_id"), *noise), "o")
    planted = frame.withColumns(
        {name: F.when(F.col("row_id") < 10, 5.0).otherwise(F.col(name)) for name in FEATURES}
    )
    _, scored = fit_isolation_forest(planted, keep=("row_id",), contamination=10 / 3000)
    top = scored.orderBy(F.desc("anomaly_score")).limit(10)
    assert {row[0] for row in top.select("row_id").collect()} == set(range(10))


def test_tiny_and_constant_tables(spark):
    values = [F.lit(1.0).alias(name) for name in FEATURES]
    frame = spark.range(5).select(F.col("id").alias("row_id"), *values)
    model, scored = fit_isolation_forest(frame)
    assert model.psi == 5
    assert scored.where("is_anomaly").count() == 0  # equal rows all score the same
    with pytest.raises(ValueError):
        fit_isolation_forest(frame.limit(1))


def test_score_report(spark, fitted):
    model, _ = fitted
    requests = transactions(
        spark,
        ("a1b2c3d4e5f6", 250, 1000, 5000, 2, 2, 1000000, 995000),
        ("zero", 0, 0, 5000, 2, 2, 1000000, 995000),
        ("missing", None, 0, 5000, 2, 2, 1000000, 995000),
    )
    found = {row[0]: row for row in score_report(requests, model).collect()}
    assert found["a1b2c3d4e5f6"]["anomaly_score"] is not None
    assert found["a1b2c3d4e5f6"]["explanation"]
    assert found["zero"]["anomaly_score"] is not None
    assert tuple(found["missing"])[1:] == (None, None, None)


def test_scoring_agrees_in_place_and_in_training(table, fitted):
    model, scored = fitted
    again = model.score(complete_rows(table)).select("hash", "anomaly_score", "is_anomaly")
    assert rows(again) == rows(scored.select("hash", "anomaly_score", "is_anomaly"))


def test_stream_scores_equal_batch_scores(spark, table, fitted, tmp_path):
    from txsieve.operators.records import to_messages

    model, _ = fitted
    folder, out = str(tmp_path / "messages"), str(tmp_path / "out")
    flat = table.drop("transaction_time")
    messages.write_message_files(to_messages(flat), folder)
    tx = pipelines.enriched(messages.file_stream(spark, folder))
    pipelines.start_scores(tx, model, f"{out}/t", f"{out}/c", trigger=None).awaitTermination()
    streamed = spark.read.parquet(f"{out}/t")
    assert rows(streamed) == rows(score_report(flat, model))


def test_registry_versions(spark, fitted, tmp_path):
    model, _ = fitted
    path = str(tmp_path / "models")
    with pytest.raises(ValueError):
        registry.load_model(spark, path)
    assert registry.save_model(spark, path, model) == 1
    assert registry.save_model(spark, path, model) == 2
    assert registry.latest_params(spark, path).first()["version"] == 2
    assert registry.load_model(spark, path) == model
    assert registry.load_model(spark, path, 1) == model
    with pytest.raises(ValueError):
        registry.load_model(spark, path, 9)


def test_half_written_version_is_invisible(spark, fitted, tmp_path):
    model, _ = fitted
    path = str(tmp_path / "models")
    registry.save_model(spark, path, model)
    nodes = spark.createDataFrame(model.nodes[:3], iforest.NODE_SCHEMA)
    nodes.write.parquet(f"{path}/nodes/version=2")
    assert registry.latest_params(spark, path).first()["version"] == 1
    assert registry.save_model(spark, path, model) == 3
    assert registry.load_model(spark, path) == model


def test_train_and_score_jobs(spark, sf_dir, tmp_path):
    table, out = str(tmp_path / "history"), str(tmp_path / "out")
    with pytest.raises(ValueError):
        jobs.train(spark, table, out)
    tx = fixtures.enriched_transactions(spark, sf_dir).drop("time", "label")
    history.append_history(tx, table)
    run = jobs.train(spark, table, out, n_trees=20)
    assert run.version == 1 and run.csv_written
    metrics = {row["key"]: row["value"] for row in run.metrics.collect()}
    assert metrics["num_transactions"] == complete_rows(tx).count()
    assert len(metrics) == 9
    params = {row["key"]: row["value"] for row in runlog.read_params(spark, f"{out}/runs").collect()}
    assert params == {"contamination": "0.01", "n_estimators": "20", "random_state": "42"}
    flagged = run.scored.where("is_anomaly")
    exported = exports.read_anomalies_csv(flagged, f"{out}/anomalies/run={run.run_id}")
    assert rows(exported) == rows(flagged)
    report = jobs.score(tx, f"{out}/models")
    assert report.columns == ["transaction_hash", "anomaly_score", "is_anomaly", "explanation"]
    assert report.count() == tx.count()


def test_nothing_flagged_writes_no_csv(spark, fitted, tmp_path):
    _, scored = fitted
    path = tmp_path / "csv"
    assert not exports.write_anomalies_csv(scored.where("not is_anomaly"), str(path))
    assert not path.exists()


def test_golden_ratios(spark):
    """Rows typed from a published run: the fee rate is fee / size to the last digits."""
    golden = [
        (12908.596566682427, 37981.00564972802, 1842356.1671244598, 142.72319671680268),
        (1107.0606012305732, 13001.435714568093, 29670512.68288458, 26801.1639560687),
    ]
    frame = spark.createDataFrame(golden, "size double, weight double, fee double, rate double")
    for row in enrich.with_ratios(frame).collect():
        assert row["fee_rate"] == pytest.approx(row["rate"], rel=1e-12)
