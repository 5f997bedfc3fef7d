"""Column helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space and the five ASCII controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda that refers to a plain expression evaluates it again for every
    element; bound as the variable of an outer lambda it is a field access.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Runs of characters other than white space; no words for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nullable_key(column: Column) -> Column:
    """A string that is equal for equal values and takes NULL as a value of its own."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))
