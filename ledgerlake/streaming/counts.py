"""Continuous event counts per table and operation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators.changes import with_operation
from ledgerlake.sinks import segments

# What a counter does unless told otherwise.
DRAIN = {"availableNow": True}


def running_counts(log: DataFrame) -> DataFrame:
    """Counts of a raw-log stream; the state has one row per table and operation."""
    return with_operation(log).groupBy("table", "operation").agg(F.count("*").alias("n"))


def batch_name(batch_id: int) -> str:
    return f"{batch_id:012d}"


def replace_counts(batch: DataFrame, batch_id: int, path: str) -> bool:
    """Make the batch's rows the whole table; returns whether they were new.

    Older batches are out with the line that lists this one. A replay of the last batch changes nothing.
    """
    name = batch_name(batch_id)
    before = [old for old in segments.live(batch.sparkSession, path) if old < name]
    return segments.write_segment(batch.repartition(1), path, name, replaces=before)


def start_counts(
    counts: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] = DRAIN
) -> StreamingQuery:
    """Keep a small table with the current counts, read by :func:`read_counts`.

    ``trigger`` is any of Structured Streaming's: the default drains what is there and stops,
    ``{"processingTime": "10 seconds"}`` keeps counting. The counts meet in one file after the state, which
    stays spread over its partitions.
    """
    return (
        counts.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, batch_id: replace_counts(batch, batch_id, path) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of the last batch that was listed."""
    found = segments.read_segments(spark, path)
    return found if found is not None else spark.createDataFrame([], "table STRING, operation STRING, n BIGINT")
