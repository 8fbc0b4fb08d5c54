"""How far a stream has come, from its checkpoint: no landed row is read.

A checkpoint has a file per batch in ``offsets`` (written before the batch runs: a version, a line of settings, a line
per source) and one in ``commits`` (written after it). What counts as read is what the last *committed* batch covers,
so it includes offsets that a compacted topic no longer holds and leaves out a batch that was planned only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The lines of an offset file before those of its sources, and how a log source states its offsets.
SOURCES_FROM = 2
LOG_OFFSETS = "map<string, map<string, bigint>>"


def _files(spark: SparkSession, folder: str) -> DataFrame | None:
    """``path`` of every file below a folder; nothing where the folder is missing."""
    try:
        return spark.read.format("binaryFile").load(folder).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _number(path: Column) -> Column:
    """The batch that a file is named after; NULL for a file of another kind."""
    return F.regexp_extract(path, r"/([0-9]+)$", 1).try_cast("bigint")


def committed_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """Number of the last committed batch; ``None`` for a stream that has committed none."""
    files = _files(spark, f"{checkpoint}/commits")
    return None if files is None else files.agg(F.max(_number(F.col("path"))).alias("batch")).first().batch


def stream_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that a checkpoint keeps over restarts; a new checkpoint has another one."""
    if _files(spark, f"{checkpoint}/metadata") is None:
        return None
    line = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()
    return line and spark.range(1).select(F.get_json_object(F.lit(line.value), "$.id")).first()[0]


def offsets_in(files: DataFrame) -> DataFrame:
    """``batch, topic, partition, next_offset`` from offset files given as ``batch, text``.

    Sources of other kinds, such as files, have lines of another form and give no row.
    """
    lines = files.select("batch", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    topics = lines.filter(F.col("place") >= SOURCES_FROM).select(
        "batch", F.explode(F.from_json("line", LOG_OFFSETS)).alias("topic", "partitions")
    )
    parts = topics.select("batch", "topic", F.explode("partitions").alias("partition", "next_offset"))
    return parts.select("batch", "topic", F.col("partition").cast("int").alias("partition"), "next_offset")


def last_committed(offsets: DataFrame, commits: DataFrame) -> DataFrame:
    """``topic, partition, next_offset`` of the last batch in ``commits`` (batch)."""
    last = commits.agg(F.max("batch").alias("batch"))
    return offsets.join(F.broadcast(last), "batch", "left_semi").select("topic", "partition", "next_offset")


def committed_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Next offset to read per topic and partition, as of the last committed batch."""
    batch = committed_batch(spark, checkpoint)
    if batch is None:
        return spark.createDataFrame([], "topic string, partition int, next_offset bigint")
    text = spark.read.text(f"{checkpoint}/offsets/{batch}", wholetext=True)
    return offsets_in(text.select(F.lit(batch).alias("batch"), F.col("value").alias("text"))).drop("batch")
