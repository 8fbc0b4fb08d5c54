"""Capture latency: pair accepted operations with their change events and summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.changes import LIVE_OPERATIONS, open_envelope
from ledgerlake.operators.ranking import order_statistics, ordinals

# Fields of an event envelope that carry its clocks.
_EVENT = (
    "payload STRUCT<op: STRING, before: STRUCT<id: STRING>, after: STRUCT<id: STRING>, "
    "source: STRUCT<ts_ms: BIGINT>, ts_ms: BIGINT>"
)


# A row with more operations than this is numbered in buckets, apart from the others; so many rows at most.
CROWD, CROWDS = 1000, 10_000


def live_events(log: DataFrame, table: str) -> DataFrame:
    """Live changes of one table: ``row_id, offset, partition, log_ts, event_op, emitted_ms, source_ms``."""
    row_id = F.coalesce(F.col("after.id"), F.col("before.id")).try_cast("bigint")
    return (
        log.filter((F.col("table") == table) & F.col("value").isNotNull())
        .select("offset", "partition", "log_ts", open_envelope(_EVENT))
        .filter(F.col("op").isin(*LIVE_OPERATIONS))
        .select(
            row_id.alias("row_id"),
            "offset",
            "partition",
            "log_ts",
            F.col("op").alias("event_op"),
            F.col("ts_ms").alias("emitted_ms"),
            F.col("source.ts_ms").alias("source_ms"),
        )
        .filter(F.col("row_id").isNotNull())
    )


def _measured(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "row_id",
        "ordinal",
        "op",
        "event_op",
        (F.col("emitted_ms") - F.col("sent_ms")).alias("sent_to_emit_ms"),
        (F.col("emitted_ms") - F.col("answered_ms")).alias("answer_to_emit_ms"),
        (F.col("emitted_ms") - F.col("source_ms")).alias("source_to_emit_ms"),
        F.col("event_op").isNotNull().alias("has_event"),
    )


def _paired_at_once(operations: DataFrame, events: DataFrame, most: int) -> DataFrame:
    """Pairs where no row has more than ``most`` operations: both sides numbered in one sort.

    Only the first ``most`` events of a row can have a partner, so Spark drops the others of a row
    before the shuffle, however many it has.
    """
    nothing = lambda kind: F.lit(None).cast(kind)
    sides = operations.select(
        "row_id", F.lit(0).alias("side"), F.col("sent_ms").alias("place"), F.col("seq").alias("tie"), nothing("timestamp").alias("log_ts"),
        "op", "sent_ms", "answered_ms", nothing("string").alias("event_op"), nothing("bigint").alias("emitted_ms"),
        nothing("bigint").alias("source_ms"),
    ).unionByName(
        events.select(
            "row_id", F.lit(1).alias("side"), F.col("offset").alias("place"), F.col("partition").cast("bigint").alias("tie"), "log_ts",
            nothing("string").alias("op"), nothing("bigint").alias("sent_ms"), nothing("bigint").alias("answered_ms"),
            "event_op", "emitted_ms", "source_ms",
        )
    )
    in_order = Window.partitionBy("row_id", "side").orderBy("place", "tie", "log_ts")
    numbered = sides.withColumn("ordinal", F.row_number().over(in_order)).filter(F.col("ordinal") <= most)
    # At most one operation and one event have the same row and ordinal.
    values = ["op", "sent_ms", "answered_ms", "event_op", "emitted_ms", "source_ms"]
    met = numbered.groupBy("row_id", F.col("ordinal").cast("bigint").alias("ordinal")).agg(
        F.min("side").alias("_side"), *[F.max(v).alias(v) for v in values]
    )
    return _measured(met.filter(F.col("_side") == 0))


def _paired_in_buckets(operations: DataFrame, events: DataFrame) -> DataFrame:
    """Pairs of rows with very many operations: ordinals by counts per bucket, so no task sorts a whole row."""
    numbered_events = ordinals(events, ["row_id"], "offset", ["partition", "log_ts"])
    numbered = ordinals(operations, ["row_id"], "sent_ms", ["seq"])
    return _measured(numbered.join(numbered_events, ["row_id", "ordinal"], "left"))


def pair_operations(operations: DataFrame, events: DataFrame, crowd: int = CROWD, crowds: int = CROWDS) -> DataFrame:
    """Each operation with the event of the same ordinal of its row, or with none.

    ``operations`` has ``row_id, seq, op, sent_ms, answered_ms``; ``seq`` is its place in
    its log document. The events of a row are numbered by offset, then partition and time, its operations by the time
    they were sent. Operations are counted per row first; the ``crowds`` rows that have most of them, if more than
    ``crowd`` each, are numbered in buckets, and no other row has more operations than the last of those.
    """
    operations = operations.filter(F.col("row_id").isNotNull())
    counts = operations.groupBy("row_id").agg(F.count("*").alias("n")).filter(F.col("n") > crowd)
    largest = counts.orderBy(F.desc("n"), "row_id").limit(crowds + 1).collect()  # most often none
    if not largest:
        return _paired_at_once(operations, events, crowd)
    apart = operations.sparkSession.createDataFrame([(r.row_id,) for r in largest[:crowds]], "row_id bigint")
    apart = F.broadcast(apart)  # crowds ids at most
    most = largest[crowds].n if len(largest) > crowds else crowd
    others = [rows.join(apart, "row_id", "left_anti") for rows in (operations, events)]
    crowded = [rows.join(apart, "row_id", "left_semi") for rows in (operations, events)]
    return _paired_at_once(*others, most).unionByName(_paired_in_buckets(*crowded))


def unmatched(pairs: DataFrame) -> DataFrame:
    """Operations whose event has not arrived."""
    return pairs.filter(~F.col("has_event")).select("row_id", "ordinal", "op")


def latency_summary(pairs: DataFrame, clock_skew_ms: int | None = None) -> DataFrame:
    """Count, minimum, median, nearest-rank p95 and maximum of each measure.

    ``clock_skew_ms`` is how far the emitting clock runs ahead of the client's; given, it
    adds the corrected variants of the two measures that mix those clocks.
    """
    measures = {
        "sent_to_emit": F.col("sent_to_emit_ms"),
        "answer_to_emit": F.col("answer_to_emit_ms"),
        "source_to_emit": F.col("source_to_emit_ms"),
    }
    if clock_skew_ms is not None:
        measures["sent_to_emit_corrected"] = F.col("sent_to_emit_ms") - clock_skew_ms
        measures["answer_to_emit_corrected"] = F.col("answer_to_emit_ms") - clock_skew_ms
    long = (
        pairs.select(
            F.explode(
                F.array(
                    *[F.struct(F.lit(m).alias("measure"), v.alias("ms")) for m, v in measures.items()]
                )
            ).alias("m")
        )
        .select("m.measure", "m.ms")
        .filter(F.col("ms").isNotNull())
    )
    n = F.col("_n")
    stats = order_statistics(
        long,
        ["measure"],
        "ms",
        {
            "min_ms": F.lit(0),
            "_mid_lo": F.floor((n - 1) / 2),
            "_mid_hi": F.ceil((n - 1) / 2),
            "p95_ms": F.greatest(F.ceil(n * 95 / 100) - 1, F.lit(0)),
            "max_ms": n - 1,
        },
    )
    # Round half to even, as for a displayed median of whole milliseconds.
    median = F.bround((F.col("_mid_lo") + F.col("_mid_hi")).cast("decimal(20,1)") / 2, 0)
    return stats.select(
        "measure",
        n.alias("n"),
        "min_ms",
        median.cast("bigint").alias("median_ms"),
        "p95_ms",
        "max_ms",
    )
