"""Landed feed documents: JSON text files, one document per line or per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txsieve.operators.records import explode_feed, rejected_documents


def read_feed(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Nested transactions of all documents below ``path``; bad documents give none."""
    documents = spark.read.text(path, wholetext=whole_files)
    return explode_feed(documents)


def read_rejected(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Raw text of the documents below ``path`` that do not parse; its count is the error metric."""
    return rejected_documents(spark.read.text(path, wholetext=whole_files))


def stream_feed(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """The same for documents that keep landing."""
    documents = spark.readStream.text(path, wholetext=whole_files)
    return explode_feed(documents)
