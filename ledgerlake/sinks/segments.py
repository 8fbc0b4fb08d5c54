"""A table as a set of segments: folders that a list names, switched in one step.

A segment is written to a folder of its own and counts only when a line of the list names it. A line may also name the
segments that the new one replaces; from that line on they are out. So a reader resolves the list first and sees
either the old folders or the new one, never both and never half of one. A writer that dies before the line leaves the table as it
was, and writes over its own folder when it comes back; one that dies after it finds its name in the list and writes
nothing. Lines are only added (by one writer of a name at a time), which suits object stores; folders that were replaced go
with :func:`expire`, after a time that no reader needs them longer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Folders and layout of the list.
LIST, DATA, SEGMENT = "_segments", "data", "segment"
LINE = "segment STRING, replaces ARRAY<STRING>, listed_at TIMESTAMP"


def listed(spark: SparkSession, root: str) -> DataFrame:
    """The lines of the list; none where nothing has been written."""
    try:
        return spark.read.schema(LINE).json(f"{root}/{LIST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LINE)


def _replaced(lines: DataFrame) -> DataFrame:
    """``segment, since``: segments that are out, and from when on."""
    return lines.select(F.explode("replaces").alias(SEGMENT), "listed_at").groupBy(SEGMENT).agg(F.min("listed_at").alias("since"))


def live(spark: SparkSession, root: str) -> list[str]:
    """Names of the segments that make up the table, in order; a line is a batch or a compaction, so they are few."""
    lines = listed(spark, root)
    kept = lines.select(SEGMENT).distinct().join(_replaced(lines), SEGMENT, "left_anti")
    return sorted(row.segment for row in kept.collect())


def is_listed(spark: SparkSession, root: str, name: str) -> bool:
    return not listed(spark, root).filter(F.col(SEGMENT) == name).isEmpty()


def _path(root: str, name: str) -> str:
    return f"{root}/{DATA}/{SEGMENT}={name}"


def write_segment(
    rows: DataFrame, root: str, name: str, partition_by: Sequence[str] = (), replaces: Callable[[], Sequence[str]] | Sequence[str] = ()
) -> bool:
    """Write the rows as a segment and list it; returns whether it was new.

    ``replaces`` may be a function, which is asked once the rows are written.
    """
    spark = rows.sparkSession
    if is_listed(spark, root, name):
        return False
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(_path(root, name))
    out = list(replaces() if callable(replaces) else replaces)
    line = spark.createDataFrame([(name, out, datetime.now(timezone.utc))], LINE)
    line.coalesce(1).write.mode("append").json(f"{root}/{LIST}")
    return True


def read_segments(spark: SparkSession, root: str, names: Sequence[str] | None = None, schema=None) -> DataFrame | None:
    """The rows of the live segments (or of those named); ``None`` where there are none."""
    names = live(spark, root) if names is None else names
    if not names:
        return None
    reader = spark.read.option("basePath", f"{root}/{DATA}")
    reader = reader if schema is None else reader.schema(schema)
    return reader.parquet(*[_path(root, name) for name in names]).drop(SEGMENT)


def expire(spark: SparkSession, root: str, older_than: timedelta) -> list[str]:
    """Delete the folders of segments that were replaced longer ago than that; returns their names."""
    before = datetime.now(timezone.utc) - older_than
    gone = _replaced(listed(spark, root)).filter(F.col("since") <= F.lit(before)).orderBy(SEGMENT).collect()
    deleted = []
    for row in gone:  # one per replaced batch
        path = spark._jvm.org.apache.hadoop.fs.Path(_path(root, row.segment))
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
            deleted.append(row.segment)
    return deleted
