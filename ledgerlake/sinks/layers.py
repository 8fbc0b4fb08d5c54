"""Idempotent writes of lake layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlake.session import scratch_dir


def write_layer(
    rows: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    single_file: bool = False,
    mode: str = "overwrite",
) -> int:
    """Write a layer as Parquet and return its row count, observed while writing.

    ``cluster_by`` rebalances by those columns: about one file per value, while AQE splits a
    value that outgrows a partition and merges the small ones. ``single_file`` suits tables of
    moderate size: all tasks write a compressed staging table, which one task copies, so it
    reads encoded columns rather than shuffled rows.
    """
    observed = Observation()
    counted = rows.observe(observed, F.count(F.lit(1)).alias("n"))
    if single_file:
        return _write_single(counted, observed, path, partition_by, mode)
    if cluster_by:
        counted = counted.hint("rebalance", *cluster_by)
    writer = counted.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return observed.get["n"]


def _write_single(
    counted: DataFrame, observed: Observation, path: str, partition_by: Sequence[str], mode: str
) -> int:
    """Stage rows with all tasks, then copy them into one file (one per partition value)."""
    spark = counted.sparkSession
    staging = scratch_dir(spark, "single-file")
    counted.write.option("compression", "zstd").parquet(staging)
    writer = spark.read.schema(counted.schema).parquet(staging).coalesce(1).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(staging)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return observed.get["n"]
