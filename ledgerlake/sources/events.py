"""Change-event streams with the columns of a Kafka source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns of the Kafka source that the landing step reads.
MESSAGE = "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, key BINARY, value BINARY"


def kafka_events(
    spark: SparkSession,
    servers: str,
    topic_pattern: str,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    source: str = "kafka",
    min_partitions: int | None = None,
) -> DataFrame:
    """Stream of every topic that matches the pattern.

    ``starting`` only applies to the first run; later runs resume from the checkpoint. ``min_partitions`` cuts
    the offsets of a batch into so many tasks at least, where topics have few partitions. The
    connector jar has to be on the classpath of the session.
    """
    reader = (
        spark.readStream.format(source)
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", topic_pattern)
        .option("startingOffsets", starting)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def file_events(
    spark: SparkSession,
    path: str,
    schema: str = MESSAGE,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of Parquet files with the message columns (replays, and tests without a broker)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
