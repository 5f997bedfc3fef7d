"""Session factory and the shared scratch location."""

from __future__ import annotations

import importlib.util
import os
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def build_session(app: str = "txsieve", master: str | None = None, **conf: object) -> SparkSession:
    """Session with the settings the package relies on.

    ``master`` stays unset on a cluster so that ``spark-submit`` decides. Keyword
    settings use ``__`` for dots: ``spark__sql__shuffle__partitions=2000``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if importlib.util.find_spec("delta") is not None:
        builder = builder.config(
            "spark.sql.extensions", "io.delta.sql.DeltaSparkSessionExtension"
        ).config(
            "spark.sql.catalog.spark_catalog", "org.apache.spark.sql.delta.catalog.DeltaCatalog"
        )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Operators with Python code call it, so the package works from a plain
    checkout; with ``--py-files`` or an installed package it changes nothing.
    """
    archive_name = f"{__package__}_package.zip"
    context = spark.sparkContext
    if any(path.endswith(archive_name) for path in context.listFiles):
        return
    package = pathlib.Path(__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="txsieve-"), archive_name)
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a fresh
    temporary folder. A cluster without it is a configuration error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="txsieve-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh, unused path below the shared folder."""
    return f"{shared_dir(spark)}/txsieve/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back.

    A columnar table, unlike an RDD checkpoint, still lets later passes read
    only the columns they need, and it survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
