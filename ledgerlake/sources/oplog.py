"""Operation log of a client: JSON documents with one entry per API call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Layout of the log and the HTTP codes that mean success.
OPERATION_LOG = (
    "api STRING, usuarioId BIGINT, operaciones ARRAY<STRUCT<op: STRING, egresoId: BIGINT, "
    "enviado: STRING, respondido: STRING, http: INT>>"
)
SUCCESS_FROM, SUCCESS_BELOW = 200, 300


def read_operation_log(spark: SparkSession, path: str) -> DataFrame:
    """``seq, op, row_id, sent_ms, answered_ms, http`` per operation of JSON log documents."""
    documents = spark.read.schema(OPERATION_LOG).json(path, multiLine=True)
    return operations(documents, F.col("operaciones"))


def operations(documents: DataFrame, entries: Column) -> DataFrame:
    """One row per entry of a log document; ``seq`` is its place in the document."""
    entry = F.col("entry")
    opened = documents.select(F.posexplode_outer(entries).alias("pos", "entry"))
    return opened.filter(entry.isNotNull()).select(
        F.col("pos").cast("bigint").alias("seq"),
        entry["op"].alias("op"),
        entry["egresoId"].alias("row_id"),
        iso_millis(entry["enviado"]).alias("sent_ms"),
        iso_millis(entry["respondido"]).alias("answered_ms"),
        entry["http"].alias("http"),
    )


def iso_millis(text: Column) -> Column:
    """Epoch milliseconds of an ISO-8601 text such as ``2026-10-14T20:01:02.345Z``."""
    return F.unix_millis(text.cast("timestamp"))


def accepted(operation_log: DataFrame) -> DataFrame:
    """Operations the API answered with success."""
    return operation_log.filter((F.col("http") >= SUCCESS_FROM) & (F.col("http") < SUCCESS_BELOW))
