"""Nested feed documents, flat transactions and JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txsieve.functions.clock import epoch_to_timestamp
from txsieve.functions.nested import array_length, array_total
from txsieve.functions.numeric import falsy_default
from txsieve.schemas import FEED_SCHEMA, MESSAGE_FIELDS, MESSAGE_SCHEMA

# What an empty scoring form field stands for.
INPUT_DEFAULTS = {
    "hash": "test_transaction",
    "size": 250,
    "weight": 1000,
    "fee": 5000,
    "inputs_count": 2,
    "outputs_count": 2,
    "input_value": 1000000,
    "output_value": 995000,
}
CORRUPT = "_corrupt_record"
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def explode_feed(documents: DataFrame, column: str = "value") -> DataFrame:
    """One row per nested transaction of each JSON document.

    A malformed document parses to NULL and an absent ``txs`` key to a NULL
    array; both contribute no rows.
    """
    parsed = documents.select(F.from_json(F.col(column), FEED_SCHEMA).alias("doc"))
    return parsed.select(F.explode("doc.txs").alias("tx")).select("tx.*")


def rejected_documents(documents: DataFrame, column: str = "value") -> DataFrame:
    """Raw text of the documents that are no JSON of the feed's shape; batch or streaming."""
    schema = f"{FEED_SCHEMA}, {CORRUPT} string"
    parsed = F.from_json(F.col(column), schema, {"columnNameOfCorruptRecord": CORRUPT})
    return documents.where(parsed[CORRUPT].isNotNull()).select(column)


def flatten_transactions(nested: DataFrame) -> DataFrame:
    """Nine flat message fields per nested transaction."""
    return nested.select(
        "hash",
        "time",
        "size",
        "weight",
        "fee",
        array_length(F.col("inputs")).alias("inputs_count"),
        array_length(F.col("out")).alias("outputs_count"),
        array_total(F.col("inputs"), lambda item: item["prev_out"]["value"]).alias("input_value"),
        array_total(F.col("out"), lambda item: item["value"]).alias("output_value"),
    )


def to_messages(flat: DataFrame) -> DataFrame:
    """Flat transactions as JSON text in a ``value`` column, no key.

    NULL fields are written as JSON nulls so that every message carries all
    nine fields.
    """
    fields = F.struct(*[F.col(name) for name in MESSAGE_FIELDS])
    return flat.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def message_id(messages: DataFrame) -> Column:
    """Identity of a message: its place in its topic, a ``row_id`` it came with, or else its text.

    Only the first two tell exact copies apart.
    """
    if {"topic", "partition", "offset"} <= set(messages.columns):
        return F.xxhash64("topic", "partition", "offset")
    return F.col("row_id") if "row_id" in messages.columns else F.xxhash64("value")


def decode_messages(messages: DataFrame, identify: bool = False) -> DataFrame:
    """Binary or text ``value`` → nine typed columns, and ``row_id`` if asked for.

    Parsing is permissive: an unreadable message becomes an all-NULL row and an
    unreadable field a NULL, so nothing is lost on the way to the history table.
    """
    parsed = F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA).alias("data")
    if identify:
        return messages.select(parsed, message_id(messages).alias("row_id")).select("data.*", "row_id")
    return messages.select(parsed).select("data.*")


def with_event_time(flat: DataFrame) -> DataFrame:
    """Replace Unix seconds by ``transaction_time`` and stamp ``processing_time``."""
    return flat.withColumns(
        {
            "transaction_time": epoch_to_timestamp(F.col("time")),
            "processing_time": F.current_timestamp(),
        }
    ).drop("time")


def with_input_defaults(df: DataFrame) -> DataFrame:
    """Replace NULL, 0 and empty text in request fields by the form defaults."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            name: falsy_default(name, default).cast(types[name])
            for name, default in INPUT_DEFAULTS.items()
        }
    )


def to_json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON text, timestamps in ISO form with milliseconds."""
    options = {
        "timestampFormat": ISO_MILLIS,
        "timestampNTZFormat": ISO_MILLIS,
        "ignoreNullFields": "false",
    }
    return df.select(F.to_json(F.struct("*"), options).alias("json"))


def from_json_rows(df: DataFrame, schema: object) -> DataFrame:
    """Inverse of :func:`to_json_rows` for a given schema."""
    options = {"timestampFormat": ISO_MILLIS, "timestampNTZFormat": ISO_MILLIS}
    return df.select(F.from_json("json", schema, options).alias("row")).select("row.*")
