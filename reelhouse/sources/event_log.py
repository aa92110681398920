"""Event streams: a message topic, or files of the same messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelhouse.functions.events import to_wire

WIRE_SCHEMA = "key STRING, value STRING"


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    messages_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded messages of a Kafka topic (needs Spark's Kafka connector).

    Offsets live in the query's checkpoint, so a restart resumes where it ended.
    A limit per trigger keeps the first batch after a long stop small.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if messages_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", messages_per_trigger)
    return reader.load()


def write_message_files(events: DataFrame, path: str) -> None:
    to_wire(events).write.mode("append").parquet(path)


def read_message_files(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Unbounded messages from files as they arrive, in place of a topic."""
    reader = spark.readStream.schema(WIRE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
