from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.operators.changes import RAW_COLUMNS
from ledgerlake.sources import events
from ledgerlake.streaming import counts, landing
from tests.conftest import rows
from tests.test_changes import event, log, row

AT = dt.datetime(2026, 3, 1, 23, 59, 59)


def send(spark, path, start, n, topic="lake.entries", value=b"{}"):
    lines = [(topic, 0, i, AT, str(i).encode(), value) for i in range(start, start + n)]
    spark.createDataFrame(lines, events.MESSAGE).coalesce(1).write.mode("append").parquet(path)


def land(spark, folder, tables=None, **options):
    stream = events.file_events(spark, f"{folder}/in", **options)
    query = landing.start_landing(landing.landing_rows(stream, "lake.", tables), f"{folder}/raw", f"{folder}/check")
    landing.drain(query)
    return query


def test_landed_rows_are_the_messages_as_they_came(spark, folder):
    odd = b'  {"not": "touched"} '
    send(spark, f"{folder}/in", 0, 1, value=odd)
    send(spark, f"{folder}/in", 1, 1, value=None)
    land(spark, folder)
    landed = spark.read.parquet(f"{folder}/raw")
    assert sorted(landed.columns) == sorted(RAW_COLUMNS)
    assert rows(landed, "table", "ingest_date", "topic", "offset", "log_ts", "key", "value") == [
        ("entries", AT.date(), "lake.entries", 0, AT, "0", odd.decode()),
        ("entries", AT.date(), "lake.entries", 1, AT, "1", None),
    ]


def test_a_restart_resumes_after_the_checkpoint(spark, folder):
    send(spark, f"{folder}/in", 0, 50)
    land(spark, folder)
    assert spark.read.parquet(f"{folder}/raw").count() == 50
    land(spark, folder)
    assert spark.read.parquet(f"{folder}/raw").count() == 50
    send(spark, f"{folder}/in", 50, 9)
    land(spark, folder)
    assert rows(spark.read.parquet(f"{folder}/raw"), "offset") == sorted([(i,) for i in range(59)], key=repr)


def test_available_now_drains_several_batches(spark, folder):
    for start in range(0, 30, 10):
        send(spark, f"{folder}/in", start, 10)
    query = land(spark, folder, max_files_per_trigger=1)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert spark.read.parquet(f"{folder}/raw").count() == 30


def test_only_allowed_tables_land(spark, folder):
    send(spark, f"{folder}/in", 0, 3)
    send(spark, f"{folder}/in", 0, 3, topic="lake.tokens")
    land(spark, folder, tables=["entries"])
    assert rows(spark.read.parquet(f"{folder}/raw").select("table").distinct()) == [("entries",)]


def test_layout_is_one_folder_per_table_and_date(spark, folder):
    send(spark, f"{folder}/in", 0, 3)
    land(spark, folder)
    files = spark.read.parquet(f"{folder}/raw").select(F.input_file_name()).distinct().collect()
    assert all("/table=entries/ingest_date=2026-03-01/" in f[0] for f in files)


def test_counts_follow_the_stream(spark, folder):
    path = f"{folder}/log"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in log(spark, None).schema.fields)

    def count():
        stream = counts.running_counts(events.file_events(spark, path, schema))
        landing.drain(counts.start_counts(stream, f"{folder}/counts", f"{folder}/check"))
        return rows(counts.read_counts(spark, f"{folder}/counts"))

    log(spark, event("c", after=row(1)), event("c", after=row(2)), None).write.mode("append").parquet(path)
    assert count() == [("entries", "INSERT", 2)]
    log(spark, event("d", before=row(1)), event("c", after=row(3))).write.mode("append").parquet(path)
    assert count() == [("entries", "DELETE", 1), ("entries", "INSERT", 3)]


class Reader:
    """Records the options of a stream reader."""

    def __init__(self):
        self.settings = {}

    def format(self, name):
        self.settings["format"] = name
        return self

    def option(self, key, value):
        self.settings[key] = value
        return self

    def load(self):
        return self.settings


def test_kafka_options():
    class Session:
        readStream = Reader()

    settings = events.kafka_events(Session(), "broker:9092", r"lake\..*", max_offsets_per_trigger=1000, min_partitions=64)
    assert settings == {
        "format": "kafka", "kafka.bootstrap.servers": "broker:9092", "subscribePattern": r"lake\..*",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": 1000, "minPartitions": 64,
    }
