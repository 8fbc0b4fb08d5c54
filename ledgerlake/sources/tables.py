"""Batch reads of lake layers and given Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.changes import RAW_COLUMNS


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table, given as ``<folder>/<name>`` or ``<folder>/<name>.parquet``."""
    return spark.read.parquet(f"{folder}/{name}")


def neutral_names(rows: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Raw-log rows under the neutral column names; ``names`` maps a neutral name to the stored one."""
    names = names or {}
    return rows.select(*[F.col(names.get(c, c)).alias(c) for c in RAW_COLUMNS])


def read_raw_log(spark: SparkSession, path: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """Raw layer under the neutral column names.

    ``names`` maps a neutral name to the name in the files. Renaming keeps partition
    pruning, since the filter on ``table`` is pushed through the projection.
    """
    return neutral_names(spark.read.parquet(path), names)
