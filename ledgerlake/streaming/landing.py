"""Land change events exactly as they arrive."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.sinks import segments

# How the landed rows are laid out, and the images of a row within an event.
LAYOUT = ("table", "ingest_date")
IMAGES = ("before", "after")
DRAIN = {"availableNow": True}


def topic_pattern(prefix: str) -> str:
    """Pattern of the topics below a prefix; the table is what follows it."""
    return f"^{re.escape(prefix)}(.+)$"


def landing_rows(messages: DataFrame, prefix: str, tables: Iterable[str] | None = None) -> DataFrame:
    """Raw-log rows of a message stream; the payload stays uninterpreted text.

    ``tables`` is the allow list of tables that may enter the lake.
    """
    rows = messages.select(
        F.regexp_extract("topic", topic_pattern(prefix), 1).alias("table"),
        F.to_date("timestamp").alias("ingest_date"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("log_ts"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )
    return rows if tables is None else rows.filter(F.col("table").isin(*tables))


def exclude_columns(rows: DataFrame, excluded: Mapping[str, Iterable[str]]) -> DataFrame:
    """Landing rows whose events don't hold the columns that are excluded for their table.

    The columns, by name without regard to case, go from both images of the row; everything else keeps its value (objects
    may list their fields in another order). A text that can't be read as an event might hold the column anywhere, so it
    doesn't land: in its place stands its length and digest, which later steps set aside as unreadable. Rows of
    other tables, and empty messages, stay as they are.
    """
    listed = {table: [c.lower() for c in columns] for table, columns in excluded.items() if columns}
    if not listed:
        return rows
    names = F.create_map(*[F.lit(x) for item in listed.items() for x in item])[F.col("table")]
    concerned = F.col("table").isin(*listed) & F.col("value").isNotNull()
    as_object = lambda field: F.try_variant_get(field, "$", "map<string, variant>")

    def cleaned(image: Column) -> Column:
        kept = F.map_filter(as_object(image), lambda name, _: ~F.array_contains(names, F.lower(name)))
        return F.to_variant_object(kept)

    def readable(image: Column) -> Column:
        return image.isNull() | F.is_variant_null(image) | as_object(image).isNotNull()

    # Step by step, so that no text is parsed more than once.
    opened = rows.withColumn("_event", F.when(concerned, F.from_json("value", "map<string, variant>")))
    opened = opened.withColumn("_payload", as_object(F.col("_event")["payload"]))
    known = F.col("_payload").isNotNull() & readable(F.col("_payload")["before"]) & readable(F.col("_payload")["after"])
    payload = F.transform_values(
        "_payload",
        lambda name, field: F.when(name.isin(*IMAGES) & as_object(field).isNotNull(), cleaned(field)).otherwise(field),
    )
    event = F.transform_values(
        "_event", lambda name, field: F.when(name == "payload", F.to_variant_object(payload)).otherwise(field)
    )
    digest = F.struct(F.length("value").alias("length"), F.sha2("value", 256).alias("sha256"))
    unreadable = F.to_json(F.struct(digest.alias("unreadable")))
    value = F.when(~concerned, F.col("value")).when(known, F.to_json(event)).otherwise(unreadable)
    return opened.withColumn("value", value).drop("_event", "_payload")


def start_landing(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = LAYOUT,
) -> StreamingQuery:
    """Append the rows to Parquet by table and date, drain what is available and stop.

    The file sink commits each batch once, so a restart neither loses nor repeats rows.
    """
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start()
    )


def clustered(rows: DataFrame, partition_by: Sequence[str] = LAYOUT, files: int = 1) -> DataFrame:
    """The rows of a batch dealt so that each table and date goes to ``files`` tasks at most.

    A batch then writes that many files per date instead of one from every task. ``files`` above 1 salts by offset, so
    that a date which holds most of a batch is written by several tasks.
    """
    salt = [] if files == 1 else [F.pmod(F.xxhash64("offset", "partition"), F.lit(files))]
    return rows.repartition(*partition_by, *salt)


def land_batch(batch: DataFrame, batch_id: int, root: str, partition_by: Sequence[str] = LAYOUT, files: int = 1) -> bool:
    """Land one batch as a segment; returns whether it was new, so a replay repeats nothing."""
    return segments.write_segment(clustered(batch, partition_by, files), root, f"{batch_id:012d}", partition_by)


def start_segment_landing(
    rows: DataFrame,
    root: str,
    checkpoint: str,
    partition_by: Sequence[str] = LAYOUT,
    files: int = 1,
    trigger: Mapping[str, object] = DRAIN,
) -> StreamingQuery:
    """As :func:`start_landing`, into segments that :func:`compact` can put together.

    ``files`` bounds the files of a batch per table and date.
    """
    return (
        rows.writeStream.foreachBatch(lambda batch, batch_id: land_batch(batch, batch_id, root, partition_by, files) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def compact(spark: SparkSession, root: str, partition_by: Sequence[str] = LAYOUT, least: int = 2) -> str | None:
    """Put the live segments together into one, where there are ``least`` of them; returns its name.

    Each table and date becomes about one file; what outgrows a partition, as a hot date does, is split by size. Batches
    that land meanwhile stay beside it. If the writer dies, the old segments are still the table.
    """
    names = segments.live(spark, root)
    if len(names) < least:
        return None
    name = f"{names[-1]}+{len(names)}"
    rows = segments.read_segments(spark, root, names).hint("rebalance", *partition_by)
    segments.write_segment(rows, root, name, partition_by, replaces=names)
    return name


def drain(query: StreamingQuery) -> None:
    """Wait until a query has stopped; re-raises its failure."""
    query.awaitTermination()
