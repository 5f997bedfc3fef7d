"""The append-only table of enriched transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txsieve.sources import commits
from txsieve.sources.commits import DATE_COLUMN, table_exists, with_event_date

DEFAULT_FORMAT = "parquet"


def file_position() -> Column:
    """Identity of a stored row: a hash of its file and its place in the file.

    It differs even among exact copies, and it is the same in every scan
    however the files are split into tasks.
    """
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def read_history(
    spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, row_id: bool = False
) -> DataFrame:
    """The stored table; ``ValueError`` if there is none at ``path``.

    A table with commit records has the rows of its live commits, whether a stream, an append or a
    compaction wrote them; any other folder is read as it is.

    With ``row_id`` it has the identity that was written with each row. Only a table
    without one gets the file positions, which copying or compacting changes.
    """
    if fmt == DEFAULT_FORMAT and commits.has_commits(spark, path):
        table = commits.read_commits(spark, path)
    elif table_exists(spark, path, fmt):
        table = spark.read.format(fmt).load(path)
    else:
        raise ValueError(f"no {fmt} table at {path}")
    if row_id and "row_id" not in table.columns:
        return table.select("*", file_position().alias("row_id"))
    return table


def append_history(
    df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, by_date: bool = False
) -> None:
    """Append a batch, optionally partitioned by event date.

    The rebalance hint gathers a date into few files and lets adaptive
    execution split a date that holds much more than the others. A Parquet table
    gets a commit record, see ``commits``; other formats keep their own log.
    """
    if by_date:
        df = with_event_date(df).hint("rebalance", DATE_COLUMN)
    if fmt == DEFAULT_FORMAT:
        commits.commit_rows(df, path, by_date=by_date)
    elif by_date:
        df.write.format(fmt).mode("append").partitionBy(DATE_COLUMN).save(path)
    else:
        df.write.format(fmt).mode("append").save(path)
