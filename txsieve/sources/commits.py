"""Commit records: which folders of a Parquet table hold its rows.

A table is a folder with one subfolder per commit and, in ``_commits``, one record
per finished commit. Stream batches, appends and compactions all write the record
after their files, so readers see whole commits only, and a batch that is run
again after a failure finds its record and writes nothing. Plain Parquet readers
can read the folder too, but they see replaced files.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT_COLUMN = "_commit"
DATE_COLUMN = "event_date"
RECORD_SCHEMA = "id string, by_date boolean, replaces array<string>"
_NO_TABLE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND"}


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether ``path`` holds a readable table of that format."""
    try:
        spark.read.format(fmt).load(path)
    except AnalysisException as error:
        condition = (error.getCondition() or "").split(".")[0]
        if condition in _NO_TABLE:
            return False
        raise
    return True


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already.

    One of several writers that ask at once gets True, on file systems that create files
    exclusively (HDFS, local disks; an object store needs its own lock).
    """
    jvm = spark._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    system = file.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    system.mkdirs(file.getParent())
    return system.createNewFile(file)


def with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn(DATE_COLUMN, F.to_date("transaction_time"))


def has_commits(spark: SparkSession, path: str) -> bool:
    return table_exists(spark, f"{path}/_commits", "text")


def live_commits(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Id and layout of the commits that hold the rows, in order of their ids."""
    records = (
        spark.read.schema(RECORD_SCHEMA).option("recursiveFileLookup", "true").json(f"{path}/_commits").collect()
    )
    replaced = {old for record in records for old in record["replaces"] or []}
    return sorted((r["id"], r["by_date"]) for r in records if r["id"] not in replaced)


def commit_rows(
    rows: DataFrame, path: str, commit: str | None = None, by_date: bool = False, replaces: list[str] | None = None
) -> str:
    """Write ``rows`` as one commit and record it; a commit with a record is left as it is.

    Files of an attempt that failed before its record are overwritten. A folder with files that no record
    knows is refused, for readers would lose them.
    """
    spark = rows.sparkSession
    commit = commit or f"append-{uuid.uuid4().hex}"
    if not has_commits(spark, path):
        if table_exists(spark, path) and COMMIT_COLUMN not in spark.read.parquet(path).columns:
            raise ValueError(f"{path} holds files without commit records; read it and append its rows to a new table")
    elif table_exists(spark, f"{path}/_commits/{commit}", "json"):
        return commit
    writer = rows.drop(COMMIT_COLUMN).write.mode("overwrite")
    if by_date:
        writer = writer.partitionBy(DATE_COLUMN)
    writer.parquet(f"{path}/{COMMIT_COLUMN}={commit}")
    record = spark.createDataFrame([(commit, by_date, replaces or [])], RECORD_SCHEMA)
    record.coalesce(1).write.mode("overwrite").json(f"{path}/_commits/{commit}")
    return commit


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all live commits, with the date column where any commit has it."""
    live = live_commits(spark, path)
    parts = []
    for by_date in (True, False):
        folders = [f"{path}/{COMMIT_COLUMN}={commit}" for commit, dated in live if dated == by_date]
        if folders:
            parts.append(spark.read.option("basePath", path).parquet(*folders).drop(COMMIT_COLUMN))
    if len(parts) == 2:
        parts[1] = with_event_date(parts[1])
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def compact(spark: SparkSession, path: str, by_date: bool = False) -> str:
    """Rewrite all rows as one commit that replaces the others; one compaction at a time.

    Commits that arrive meanwhile stay beside it. Replaced files are left to the folder's retention.
    """
    old = [commit for commit, _ in live_commits(spark, path)]
    rows = read_commits(spark, path)
    if by_date:
        rows = with_event_date(rows).hint("rebalance", DATE_COLUMN)
    return commit_rows(rows, path, f"compact-{uuid.uuid4().hex}", by_date, replaces=old)


def stream_commit(batch: DataFrame, batch_id: int) -> str:
    """Id of a stream's batch: it is the same when the batch is run again from its checkpoint."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"stream-{query}-{batch_id:012d}"
