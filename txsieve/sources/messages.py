"""Message sources and sinks. Every one carries JSON text in a ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.readwriter import DataStreamWriter

# Delivery settings of the message sink.
DELIVERY_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3", "kafka.max.block.ms": "10000"}


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    **options: str,
) -> DataFrame:
    """Streaming source for one topic; needs the Kafka connector jar."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )


def file_stream(
    spark: SparkSession, path: str, fmt: str = "text", schema: str = "value string", **options: str
) -> DataFrame:
    """Streaming source over a folder of message files."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish a batch of messages."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**DELIVERY_OPTIONS)
        .save()
    )


def kafka_writer(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Streaming form of :func:`write_kafka`; the caller sets a trigger and starts it."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**DELIVERY_OPTIONS)
        .option("checkpointLocation", checkpoint)
    )


def write_message_files(messages: DataFrame, path: str) -> None:
    """Append a batch of messages to a folder that :func:`file_stream` reads."""
    messages.select("value").write.mode("append").text(path)
