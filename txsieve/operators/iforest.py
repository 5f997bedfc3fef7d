"""Isolation Forest (Liu, Ting, Zhou, ICDM 2008) on Spark.

Sampling, ranking and scoring are distributed over the rows, growing over the
trees. Only the finished node table reaches the driver; its size depends on
the number of trees and the sample size, never on the data.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txsieve.operators.features import Preprocessor, complete_rows
from txsieve.operators.quantiles import exact_quantiles
from txsieve.schemas import (
    CONTAMINATION,
    FEATURES,
    MAX_SAMPLES,
    N_TREES,
    NODE_SCHEMA,
    SEED,
)
from txsieve.session import materialize, ship_package

EULER_GAMMA = 0.5772156649015329
OVERSAMPLE = 4
#: Scores that differ by less are equal.
ROUNDING = 1e-12


def average_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER_GAMMA) - 2.0 * (n - 1) / n


def _uniform(digest: Column, place: int = 0) -> Column:
    """A number in [0, 1) from the ``place``-th 13 digits of an md5."""
    digits = F.substring(digest, 13 * place + 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def _binomial(uniform: Column, trials: int, share: float) -> Column:
    """A binomial number of successes as the quantile that ``uniform`` stands for."""
    if share >= 1:
        return F.lit(trials)
    successes, mass, below = F.lit(0), (1 - share) ** trials, 0.0
    for k in range(trials):
        below += mass
        if below >= 1 - 2**-53:
            break
        successes = successes + (uniform >= F.lit(below)).cast("int")
        mass *= (trials - k) / (k + 1) * share / (1 - share)
    return successes


def _distinct_trees(offers: Column, row: Column, n_trees: int, seed: int) -> Column:
    """``offers`` different trees, every such set being equally likely (Floyd's method: one hash a tree)."""
    steps = F.transform(
        F.sequence(F.lit(n_trees) - offers, F.lit(n_trees - 1)),
        lambda last: F.struct(
            last.alias("last"),
            F.floor(
                _uniform(F.md5(F.concat_ws(":", F.lit(f"tree:{seed}"), row, last.cast("string")))) * (last + 1)
            ).cast("int").alias("drawn"),
        ),
    )
    return F.aggregate(
        steps,
        F.array().cast("array<int>"),
        lambda taken, step: F.array_append(
            taken, F.when(F.array_contains(taken, step["drawn"]), step["last"]).otherwise(step["drawn"])
        ),
    )


def sample_trees(
    rows: DataFrame,
    features: list[str],
    total: int,
    n_trees: int,
    psi: int,
    seed: int,
    row_id: str = "row_id",
    oversample: int = OVERSAMPLE,
) -> tuple[DataFrame, bool]:
    """``psi`` rows per tree, uniformly and without replacement.

    Every tree is offered each row with the same small chance, which leaves about
    ``oversample * psi`` rows per tree, and takes those with the smallest hashes. One
    hash of a row decides by the binomial law how many trees it is offered to, so that
    most rows of a large table are dropped in the scan; one further hash for each
    offer picks a tree. Only the offers are shuffled. The hashes cover the row's identity
    and not its content: copies of a transaction are drawn independently, so a
    group of copies takes its share of a sample and never floods it.

    All hashes are md5 of the seed, the identity and, for an offer, the tree, so that any
    engine draws the same sample. Rows of equal identity are ordered by content.

    The second value tells whether every tree was offered every row (then a
    short sample cannot be extended).
    """
    share = min(1.0, oversample * psi / total)
    row = F.col(row_id).cast("string")
    drawn = (
        rows.select(row.alias("row"), *features)
        .withColumn("offers", _binomial(_uniform(F.md5(F.concat(F.lit(f"offer:{seed}:"), "row"))), n_trees, share))
        .where(F.col("offers") > 0)
        .withColumn("tree_id", F.explode(_distinct_trees(F.col("offers"), F.col("row"), n_trees, seed)))
        .withColumn("draw", F.md5(F.concat_ws(":", F.lit(f"draw:{seed}"), F.col("tree_id").cast("string"), "row")))
    )
    by_tree = Window.partitionBy("tree_id").orderBy("draw", *features)
    tasks = min(n_trees, rows.sparkSession.sparkContext.defaultParallelism)
    sample = (
        # A stated number of partitions is not coalesced, so trees grow in parallel.
        drawn.repartition(tasks, "tree_id")
        .withColumn("place", F.row_number().over(by_tree))
        .where(F.col("place") <= psi)
        .select("tree_id", "place", *features)
    )
    return sample, share >= 1


def _draws(seed: int, tree: int, node: int) -> tuple[float, float]:
    """The two numbers in [0, 1) that split a node."""
    digest = hashlib.md5(f"split:{seed}:{tree}:{node}".encode()).hexdigest()
    return int(digest[:13], 16) / 2**52, int(digest[13:26], 16) / 2**52


def _grow(values: np.ndarray, seed: int, tree: int, max_depth: int) -> list[tuple]:
    """Nodes of one tree in heap numbering."""
    nodes, open_nodes = [], [(0, np.arange(len(values)), 0)]
    while open_nodes:
        node, members, depth = open_nodes.pop()
        inside = values[members]
        low, high = inside.min(axis=0), inside.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth == max_depth or usable.size == 0:
            nodes.append((node, None, None, None, None, len(members), depth))
            continue
        which, where = _draws(seed, tree, node)
        feature = int(usable[int(which * len(usable))])
        threshold = float(low[feature] + where * (high[feature] - low[feature]))
        if threshold >= high[feature]:  # rounding put it on the maximum
            threshold = float(low[feature])
        right = inside[:, feature] > threshold
        left_id, right_id = 2 * node + 1, 2 * node + 2
        nodes.append((node, feature, threshold, left_id, right_id, len(members), depth))
        open_nodes += [
            (right_id, members[right], depth + 1),
            (left_id, members[~right], depth + 1),
        ]
    return nodes


def grow_trees(sample: DataFrame, features: list[str], psi: int, seed: int) -> DataFrame:
    """Node table of the forest; a group holds the ``psi`` rows of one tree.

    Splits are drawn from md5 of (seed, tree, node), so a tree depends on its rows only, in no order.
    """
    ship_package(sample.sparkSession)
    max_depth = max(1, math.ceil(math.log2(psi)))
    names = ["node_id", "feature", "threshold", "left_id", "right_id", "n", "depth"]

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        nodes = _grow(rows[features].to_numpy(dtype=float), seed, tree, max_depth)
        table = pd.DataFrame(nodes, columns=names)
        for name in ("feature", "left_id", "right_id"):
            table[name] = table[name].astype("Int32")
        table.insert(0, "tree_id", tree)
        return table

    return sample.groupBy("tree_id").applyInPandas(grow, NODE_SCHEMA)


@dataclass(frozen=True)
class Forest:
    """Trees as dense arrays, one row per tree, all of the same depth.

    A leaf above the bottom level sends every row left, so its path length sits
    at its leftmost bottom slot and a walk always takes ``depth`` steps.
    """

    feature: np.ndarray
    threshold: np.ndarray
    path: np.ndarray
    depth: int
    norm: float

    @classmethod
    def from_nodes(cls, nodes: list[tuple], n_trees: int, psi: int) -> Forest:
        depth = max([1, *(node[7] for node in nodes)])
        inner = 2**depth - 1
        feature = np.zeros((n_trees, inner), dtype=np.intp)
        threshold = np.full((n_trees, inner), np.inf)
        path = np.zeros((n_trees, inner + 1))
        for tree, node, split_on, split_at, _, _, n, level in nodes:
            if split_on is None:
                path[tree, ((node + 1) << (depth - level)) - 1 - inner] = level + average_path(n)
            else:
                feature[tree, node] = split_on
                threshold[tree, node] = split_at
        return cls(feature, threshold, path, depth, average_path(psi))

    def score(self, columns: list[np.ndarray]) -> np.ndarray:
        """Anomaly score in (0, 1) per row; higher is more anomalous."""
        values = np.stack(columns, axis=1).ravel()
        starts = np.arange(len(columns[0])) * len(columns)
        total = np.zeros(len(starts))
        for feature, threshold, path in zip(self.feature, self.threshold, self.path):
            node = np.zeros(len(starts), dtype=np.intp)
            for _ in range(self.depth):
                right = values[starts + feature[node]] > threshold[node]
                node = 2 * node + 1 + right
            total += path[node - len(feature)]
        return np.exp2(-total / (len(self.path) * self.norm))


def is_above_offset(shifted: Column) -> Column:
    """Whether a score lies above the offset; a difference by rounding does not count."""
    return shifted > F.lit(ROUNDING)


@dataclass(frozen=True)
class AnomalyModel:
    """Fitted preprocessing, forest nodes and score offset."""

    preprocessor: Preprocessor
    nodes: list[tuple]
    n_trees: int
    psi: int
    seed: int
    contamination: float
    offset: float = 0.0
    trained_rows: int = 0

    def raw_score(self, spark: SparkSession) -> Column:
        """Score expression over the unscaled feature columns, NULL if one is NULL.

        At most ``n_trees * (2 * psi - 1)`` nodes are broadcast.
        """
        ship_package(spark)
        shared = spark.sparkContext.broadcast(
            Forest.from_nodes(self.nodes, self.n_trees, self.psi)
        )

        @F.pandas_udf("double")
        def forest_score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            forest = shared.value
            for batch in batches:
                yield pd.Series(forest.score([column.to_numpy(float) for column in batch]))

        complete = F.lit(True)
        for name in self.preprocessor.features:
            complete = complete & F.col(name).isNotNull()
        return F.when(complete, forest_score(*self.preprocessor.scaled_columns()))

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` and ``is_anomaly`` in place; batch or streaming."""
        shifted = self.raw_score(df.sparkSession) - F.lit(self.offset)
        return df.withColumn("anomaly_score", shifted).withColumn(
            "is_anomaly", is_above_offset(F.col("anomaly_score"))
        )


def grow_forest(
    scaled: DataFrame,
    features: list[str],
    total: int,
    n_trees: int = N_TREES,
    max_samples: int = MAX_SAMPLES,
    seed: int = SEED,
    row_id: str = "row_id",
) -> tuple[list[tuple], int]:
    """Nodes of a forest over scaled rows, and the sample size per tree."""
    psi = min(max_samples, total)
    if psi < 2:
        raise ValueError("an isolation forest needs at least two complete rows")
    oversample = OVERSAMPLE
    while True:
        sample, everything = sample_trees(
            scaled, features, total, n_trees, psi, seed, row_id, oversample
        )
        nodes = [tuple(row) for row in grow_trees(sample, features, psi, seed).collect()]
        roots = [node for node in nodes if node[1] == 0]
        if len(roots) == n_trees and all(node[6] == psi for node in roots):
            return sorted(nodes, key=lambda node: node[:2]), psi
        if everything:
            raise ValueError(f"a tree got fewer than {psi} of {total} rows")
        oversample *= 4  # some tree was offered too few rows


def fit_isolation_forest(
    df: DataFrame,
    keep: tuple[str, ...] = (),
    features: list[str] = FEATURES,
    n_trees: int = N_TREES,
    max_samples: int = MAX_SAMPLES,
    contamination: float = CONTAMINATION,
    seed: int = SEED,
    row_id: str = "row_id",
    caps: str = "exact",
) -> tuple[AnomalyModel, DataFrame]:
    """Fit on the complete rows of ``df`` and return the model and those rows scored.

    ``row_id`` names a column that differs between rows and is stable between
    scans, such as the file position added by ``read_history(..., row_id=True)``.
    The sample, and so the model, then depends on the seed and the stored rows
    but not on how the scan is split into tasks. ``df`` is scanned several times
    and should be a stored table or a cheap projection of one.

    The rows are scored once: the score and the ``keep`` columns go to a table
    in the shared folder, from which the offset that flags the
    ``contamination`` share is computed.
    """
    rows = complete_rows(df.select(*dict.fromkeys([*keep, row_id, *features])), features)
    total, named = rows.agg(F.count(F.lit(1)), F.count(row_id)).first()
    if named < total:
        raise ValueError(f"{total - named} rows have no {row_id}")
    preprocessor = Preprocessor.fit(rows, features, method=caps, rows=total).reproducible()
    scaled = preprocessor.transform(rows, row_id)
    nodes, psi = grow_forest(scaled, features, total, n_trees, max_samples, seed, row_id)
    model = AnomalyModel(
        preprocessor, nodes, n_trees, psi, seed, contamination, trained_rows=total
    )
    scored = materialize(
        rows.select(*keep, model.raw_score(df.sparkSession).alias("raw_score")), "scored"
    )
    offset = exact_quantiles(scored, ["raw_score"], 1 - contamination, rows=total)["raw_score"]
    model = replace(model, offset=offset)
    flagged = scored.select(
        *keep, (F.col("raw_score") - F.lit(offset)).alias("anomaly_score")
    ).withColumn("is_anomaly", is_above_offset(F.col("anomaly_score")))
    return model, flagged

