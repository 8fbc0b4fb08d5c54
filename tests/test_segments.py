from __future__ import annotations

import datetime as dt
import glob
import os

import pytest

from ledgerlake.sinks import segments
from ledgerlake.sources import events
from ledgerlake.streaming import counts, landing
from tests.conftest import rows
from tests.test_changes import event, log, row

NOW = dt.timedelta(0)


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n INT")


def test_segments_add_up_and_replace(spark, folder):
    assert segments.read_segments(spark, folder) is None and segments.live(spark, folder) == []
    assert segments.write_segment(numbers(spark, 1, 2), folder, "a")
    assert segments.write_segment(numbers(spark, 3), folder, "b")
    assert rows(segments.read_segments(spark, folder)) == [(1,), (2,), (3,)]
    assert segments.write_segment(numbers(spark, 1, 2, 3), folder, "c", replaces=["a", "b"])
    assert segments.live(spark, folder) == ["c"] and rows(segments.read_segments(spark, folder)) == [(1,), (2,), (3,)]


def test_a_replay_writes_nothing_and_a_dead_writer_changes_nothing(spark, folder):
    segments.write_segment(numbers(spark, 1), folder, "a")
    # A writer that died before its line: its folder is there, the table doesn't know it.
    numbers(spark, 7, 8).write.parquet(f"{folder}/{segments.DATA}/{segments.SEGMENT}=b")
    assert rows(segments.read_segments(spark, folder)) == [(1,)]
    assert segments.write_segment(numbers(spark, 2), folder, "b")
    assert not segments.write_segment(numbers(spark, 9), folder, "b")
    assert rows(segments.read_segments(spark, folder)) == [(1,), (2,)]


def test_only_replaced_segments_expire_and_only_after_a_time(spark, folder):
    segments.write_segment(numbers(spark, 1), folder, "a")
    segments.write_segment(numbers(spark, 2), folder, "b")
    segments.write_segment(numbers(spark, 1), folder, "c", replaces=["a"])
    reading = segments.read_segments(spark, folder, ["a"])
    assert segments.expire(spark, folder, dt.timedelta(hours=1)) == [] and rows(reading) == [(1,)]
    assert segments.expire(spark, folder, NOW) == ["a"] and segments.expire(spark, folder, NOW) == []
    assert rows(segments.read_segments(spark, folder)) == [(1,), (2,)]


DAYS = [dt.datetime(2026, 3, d, 12) for d in (1, 2, 3)]


def landed_rows(spark, offsets, day=lambda i: DAYS[i % 3]):
    lines = [("lake.entries", 0, i, day(i), str(i).encode(), b"{}") for i in offsets]
    return landing.landing_rows(spark.createDataFrame(lines, events.MESSAGE).repartition(4), "lake.")


def data_files(folder, name):
    return glob.glob(f"{folder}/{segments.DATA}/{segments.SEGMENT}={name}/**/*.parquet", recursive=True)


@pytest.mark.parametrize("files", [1, 3])
def test_a_batch_writes_few_files_per_date(spark, folder, files):
    assert landing.land_batch(landed_rows(spark, range(300)), 0, folder, files=files)
    per_date = {}
    for path in data_files(folder, f"{0:012d}"):
        per_date.setdefault(os.path.dirname(path), []).append(path)
    assert len(per_date) == 3 and all(len(found) <= files for found in per_date.values())
    assert not landing.land_batch(landed_rows(spark, range(300)), 0, folder, files=files)
    assert rows(segments.read_segments(spark, folder), "offset") == rows(spark.range(300))


def test_a_hot_date_is_written_by_several_tasks(spark, folder):
    hot = landed_rows(spark, range(400), lambda i: DAYS[0])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few here
    try:
        parts = landing.clustered(hot, files=4).rdd.glom().map(len).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(parts) == 400 and len([n for n in parts if n]) > 1


def test_compaction_keeps_every_row_once(spark, folder):
    for batch in range(3):
        landing.land_batch(landed_rows(spark, range(batch * 50, batch * 50 + 50)), batch, folder)
    before = rows(segments.read_segments(spark, folder))
    reader = segments.read_segments(spark, folder)
    name = landing.compact(spark, folder)
    assert segments.live(spark, folder) == [name] and len(data_files(folder, name)) == 3
    assert rows(segments.read_segments(spark, folder)) == before and rows(reader) == before
    landing.land_batch(landed_rows(spark, range(150, 160)), 3, folder)
    assert segments.read_segments(spark, folder).count() == 160
    assert landing.compact(spark, folder, least=5) is None
    assert len(segments.expire(spark, folder, NOW)) == 3
    assert segments.read_segments(spark, folder).count() == 160


def test_stream_into_segments_resumes(spark, folder):
    def send(start, n):
        lines = [("lake.entries", 0, i, DAYS[0], b"k", b"{}") for i in range(start, start + n)]
        spark.createDataFrame(lines, events.MESSAGE).write.mode("append").parquet(f"{folder}/in")

    def land():
        stream = landing.landing_rows(events.file_events(spark, f"{folder}/in"), "lake.")
        landing.drain(landing.start_segment_landing(stream, f"{folder}/raw", f"{folder}/check"))
        return rows(segments.read_segments(spark, f"{folder}/raw"), "offset")

    send(0, 20)
    assert land() == rows(spark.range(20)) and land() == rows(spark.range(20))
    send(20, 5)
    assert land() == rows(spark.range(25)) and len(segments.live(spark, f"{folder}/raw")) == 2


def test_counts_are_replaced_whole_and_a_replay_changes_nothing(spark, folder):
    def batch(n):
        return spark.createDataFrame([("entries", "INSERT", n)], "table STRING, operation STRING, n BIGINT")

    assert rows(counts.read_counts(spark, folder)) == []
    assert counts.replace_counts(batch(1), 0, folder)
    assert counts.replace_counts(batch(2), 1, folder)
    # Dies after writing, before the switch: readers keep the counts of the batch before.
    batch(99).write.parquet(f"{folder}/{segments.DATA}/{segments.SEGMENT}={counts.batch_name(2)}")
    assert rows(counts.read_counts(spark, folder)) == [("entries", "INSERT", 2)]
    assert counts.replace_counts(batch(3), 2, folder) and not counts.replace_counts(batch(3), 2, folder)
    assert rows(counts.read_counts(spark, folder)) == [("entries", "INSERT", 3)]


def test_a_counter_may_stay_up(spark, folder):
    path = f"{folder}/log"
    log(spark, event("c", after=row(1)), None).write.parquet(path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in log(spark, None).schema.fields)
    stream = counts.running_counts(events.file_events(spark, path, schema))
    query = counts.start_counts(stream, f"{folder}/counts", f"{folder}/check", {"processingTime": "0 seconds"})
    try:
        query.processAllAvailable()
        assert query.isActive and rows(counts.read_counts(spark, f"{folder}/counts")) == [("entries", "INSERT", 1)]
        log(spark, event("d", before=row(1))).write.mode("append").parquet(path)
        query.processAllAvailable()
        assert rows(counts.read_counts(spark, f"{folder}/counts")) == [("entries", "DELETE", 1), ("entries", "INSERT", 1)]
    finally:
        query.stop()
