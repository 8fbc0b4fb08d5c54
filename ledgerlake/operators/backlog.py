"""Pending work per log partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def landed_offsets(log: DataFrame) -> DataFrame:
    """Offset after the last landed row per topic and partition: what the log is known to hold."""
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def offset_backlog(available: DataFrame, consumed: DataFrame, topics: str | None = None) -> DataFrame:
    """``topic, partition, n_pending`` where more is available than was consumed.

    Both have ``topic, partition, next_offset``; what was consumed comes from the checkpoint
    (:func:`ledgerlake.streaming.progress.committed_offsets`). A partition never consumed counts from 0; one consumed
    ahead of the map is not pending. ``topics`` is the pattern of the topics that are read at all: others never are.
    """
    wanted = available if topics is None else available.filter(F.col("topic").rlike(topics))
    done = consumed.select("topic", "partition", F.col("next_offset").alias("_done"))
    pending = F.col("next_offset") - F.coalesce(F.col("_done"), F.lit(0))
    return (
        wanted.join(done, ["topic", "partition"], "left")
        .select("topic", "partition", pending.alias("n_pending"))
        .filter(F.col("n_pending") > 0)
    )
