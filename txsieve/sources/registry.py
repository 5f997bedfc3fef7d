"""Versioned model tables: forest nodes and fitted parameters.

A version is a pair of partitions ``nodes/version=N`` and ``params/version=N``.
The parameter row is written last and marks the version as complete, so readers
never see half a model. A writer first claims its number by creating a file that
must not exist, so of two trainers that finish at once each gets its own version; a
claimed number is never used again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txsieve.operators.features import Preprocessor
from txsieve.operators.iforest import AnomalyModel
from txsieve.schemas import MODEL_SCHEMA, NODE_SCHEMA
from txsieve.sources.commits import claim, table_exists


def model_versions(spark: SparkSession, path: str) -> DataFrame:
    """Parameter rows of all complete versions."""
    return spark.read.schema(f"{MODEL_SCHEMA}, version int").parquet(f"{path}/params")


def latest_params(spark: SparkSession, path: str) -> DataFrame:
    """Parameter row of the newest version; the bound prunes to its partition."""
    versions = model_versions(spark, path)
    return versions.where(F.col("version") == versions.agg(F.max("version")).scalar())


def model_nodes(spark: SparkSession, path: str, version: int) -> DataFrame:
    nodes = spark.read.schema(f"{NODE_SCHEMA}, version int").parquet(f"{path}/nodes")
    return nodes.where(F.col("version") == version)


def _next_version(spark: SparkSession, path: str) -> int:
    # Nodes come first, so a failed save has used up its number there.
    if not table_exists(spark, f"{path}/nodes"):
        return 1
    used = spark.read.schema(f"{NODE_SCHEMA}, version int").parquet(f"{path}/nodes")
    return used.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0] + 1


def save_model(spark: SparkSession, path: str, model: AnomalyModel) -> int:
    """Register a model under the next version number that nobody else has claimed."""
    version = _next_version(spark, path)
    while not claim(spark, f"{path}/claims/version={version}"):
        version += 1
    nodes = spark.createDataFrame(model.nodes, NODE_SCHEMA)
    nodes.coalesce(1).write.mode("errorifexists").parquet(f"{path}/nodes/version={version}")
    fitted = model.preprocessor
    params = (
        fitted.features,
        fitted.caps,
        fitted.means,
        fitted.sds,
        model.n_trees,
        model.psi,
        model.seed,
        model.contamination,
        model.offset,
        model.trained_rows,
        dt.datetime.now(dt.timezone.utc),
    )
    row = spark.createDataFrame([params], MODEL_SCHEMA)
    row.coalesce(1).write.mode("errorifexists").parquet(f"{path}/params/version={version}")
    return version


def load_model(spark: SparkSession, path: str, version: int | None = None) -> AnomalyModel:
    """The given or the newest complete version.

    A missing registry is an error: there is no unfitted stand-in.
    """
    if not table_exists(spark, f"{path}/params"):
        raise ValueError(f"no registered model at {path}")
    if version is None:
        params = latest_params(spark, path).first()
    else:
        params = model_versions(spark, path).where(F.col("version") == version).first()
    if params is None:
        raise ValueError(f"no model version {version} at {path}")
    nodes = model_nodes(spark, path, params["version"]).drop("version").collect()
    return AnomalyModel(
        Preprocessor(params["features"], params["caps"], params["means"], params["sds"]),
        sorted((tuple(node) for node in nodes), key=lambda node: node[:2]),
        params["n_trees"],
        params["psi"],
        params["seed"],
        params["contamination"],
        params["score_offset"],
        params["trained_rows"],
    )
