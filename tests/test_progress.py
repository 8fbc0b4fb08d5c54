from __future__ import annotations

import json
import os

import pytest

from ledgerlake import jobs
from ledgerlake.operators import backlog
from ledgerlake.plans import finance
from ledgerlake.sources import events
from ledgerlake.streaming import landing, progress
from tests import finance_lake as lakes
from tests.conftest import rows
from tests.test_finance import send
from tests.test_streaming import AT, send as send_messages

SETTINGS = json.dumps({"batchWatermarkMs": 0, "batchTimestampMs": 1, "conf": {"a": "b"}})
ENDS = "topic STRING, partition INT, next_offset BIGINT"


def checkpoint(folder, batches, committed):
    """A checkpoint as a stream over a log leaves it."""
    for name, content in [("offsets", batches), ("commits", {b: "" for b in committed})]:
        os.makedirs(f"{folder}/{name}")
        for batch, ends in content.items():
            lines = ["v1", SETTINGS, *map(json.dumps, ends)] if name == "offsets" else ["v1", '{"nextBatchWatermarkMs":0}']
            with open(f"{folder}/{name}/{batch}", "w") as file:
                file.write("\n".join(lines))
    with open(f"{folder}/metadata", "w") as file:
        json.dump({"id": "stream-1"}, file)
    return folder


def test_the_last_committed_batch_counts(spark, folder):
    path = checkpoint(
        f"{folder}/check",
        {8: [{"lake.a": {"0": 5}}], 9: [{"lake.a": {"0": 7, "1": 3}, "lake.b": {"0": 12}}], 10: [{"lake.a": {"0": 99}}]},
        committed=[8, 9],
    )
    assert progress.committed_batch(spark, path) == 9 and progress.stream_id(spark, path) == "stream-1"
    assert rows(progress.committed_offsets(spark, path)) == [("lake.a", 0, 7), ("lake.a", 1, 3), ("lake.b", 0, 12)]


def test_no_checkpoint_and_one_without_a_commit(spark, folder):
    assert progress.committed_batch(spark, f"{folder}/none") is None and progress.stream_id(spark, f"{folder}/none") is None
    assert progress.committed_offsets(spark, f"{folder}/none").isEmpty()
    path = checkpoint(f"{folder}/check", {0: [{"lake.a": {"0": 5}}]}, committed=[])
    assert progress.committed_batch(spark, path) is None and progress.committed_offsets(spark, path).isEmpty()


def test_several_sources_and_sources_of_other_kinds(spark, folder):
    path = checkpoint(f"{folder}/check", {3: [{"logOffset": 5}, {"lake.a": {"0": 5}}, {"lake.b": {"2": 6}}]}, committed=[3])
    assert rows(progress.committed_offsets(spark, path)) == [("lake.a", 0, 5), ("lake.b", 2, 6)]


def test_a_real_checkpoint(spark, folder):
    send_messages(spark, f"{folder}/in", 0, 5)
    for expected in (0, 0, 1):
        if expected:
            send_messages(spark, f"{folder}/in", 5, 5)
        stream = landing.landing_rows(events.file_events(spark, f"{folder}/in"), "lake.")
        landing.drain(landing.start_landing(stream, f"{folder}/raw", f"{folder}/check"))
        assert progress.committed_batch(spark, f"{folder}/check") == expected
    assert progress.stream_id(spark, f"{folder}/check")
    assert progress.committed_offsets(spark, f"{folder}/check").isEmpty()  # files have no log offsets


def test_backlog_ignores_foreign_topics_and_compacted_ends(spark, folder):
    path = checkpoint(f"{folder}/check", {0: [{"lake.a": {"0": 10}, "lake.c": {"0": 4}}]}, committed=[0])
    available = spark.createDataFrame([("lake.a", 0, 12), ("lake.c", 0, 4), ("lake.new", 0, 3), ("other.a", 0, 9), ("xlake.a", 0, 9)], ENDS)
    consumed = progress.committed_offsets(spark, path)
    pending = backlog.offset_backlog(available, consumed, landing.topic_pattern("lake."))
    # lake.c: its last messages were compacted away, so no landed row reaches offset 4, but all were read.
    assert rows(pending) == [("lake.a", 0, 2), ("lake.new", 0, 3)]


@pytest.fixture(scope="module")
def lake():
    return lakes.build()


def test_daily_run_is_skipped_when_idle_and_made_up_for_after_a_failure(spark, folder, lake, capsys):
    base = ["--lake", f"{folder}/lake", "--prefix", "lake.", "--messages", f"{folder}/topics"]
    daily = lambda *more: jobs.main(["daily", *base, *more])
    os.makedirs(f"{folder}/topics")
    assert daily() == jobs.SKIPPED
    send(spark, f"{folder}/topics", {**lake, "metas": []})
    assert daily() == jobs.FAILED  # an empty table does not pass its gate
    assert daily() == jobs.FAILED  # nothing is new, but no complete run is behind it
    send(spark, f"{folder}/topics", {"metas": lake["metas"]}, offset=50_000)
    assert daily() == jobs.DONE
    assert daily() == jobs.SKIPPED and "no message" in capsys.readouterr().out
    assert daily("--force") == jobs.DONE


def test_segments_are_landed_compacted_and_read_by_the_layers(spark, folder, lake):
    paths = jobs.lake_of(jobs.parser().parse_args(["daily", "--lake", f"{folder}/lake"]))
    base = ["--lake", f"{folder}/lake", "--prefix", "lake.", "--messages", f"{folder}/topics", "--segments"]
    names = list(lake)
    for part, offset in ((names[:6], 0), (names[6:], 60_000)):
        send(spark, f"{folder}/topics", {n: lake[n] for n in part}, offset=offset)
        assert jobs.main(["land", *base]) == jobs.DONE
    before = rows(finance.raw_log(spark, paths))
    assert jobs.main(["compact", *base]) == jobs.DONE and jobs.main(["compact", *base]) == jobs.SKIPPED
    assert rows(finance.raw_log(spark, paths)) == before
    assert jobs.main(["state", *base]) == jobs.DONE and jobs.main(["profile", *base]) == jobs.DONE
    assert spark.read.parquet(f"{paths.state}/egresos").count() == len(lake["egresos"])


def test_backlog_job(spark, folder, capsys):
    checkpoint(f"{folder}/lake/checkpoints/raw", {0: [{"lake.a": {"0": 10}}]}, committed=[0])
    base = ["backlog", "--lake", f"{folder}/lake", "--prefix", "lake."]
    assert jobs.main(base) == jobs.SKIPPED
    for end, code in ((10, jobs.SKIPPED), (13, jobs.DONE)):
        with open(f"{folder}/ends.json", "w") as file:
            file.write(json.dumps({"topic": "lake.a", "partition": 0, "next_offset": end}))
        assert jobs.main([*base, "--available", f"{folder}/ends.json"]) == code
    assert "lake.a\t0\t3" in capsys.readouterr().out


EXCLUDED = {"entries": ["secret"], "empty": []}


@pytest.mark.parametrize(
    "value, wanted",
    [
        (None, None),
        ({"op": "c", "before": None, "after": {"id": 1, "secret": "s"}}, {"op": "c", "before": None, "after": {"id": 1}}),
        (
            {"op": "u", "before": {"SECRET": 1, "n": {"a": [1, None]}}, "after": {"secret": None, "x": "y"}, "source": {"secret": 2}},
            {"op": "u", "before": {"n": {"a": [1, None]}}, "after": {"x": "y"}, "source": {"secret": 2}},
        ),
        ({"op": "d", "before": {"id": 1}}, {"op": "d", "before": {"id": 1}}),
    ],
)
def test_excluded_columns_leave_everything_else(spark, value, wanted):
    text = None if value is None else json.dumps({"payload": value})
    found = exclude(spark, text)
    assert (found and json.loads(found)) == (wanted and {"payload": wanted})


def exclude(spark, text, table="entries"):
    message = spark.createDataFrame([(f"lake.{table}", 0, 1, AT, b"k", None if text is None else text.encode())], events.MESSAGE)
    return landing.exclude_columns(landing.landing_rows(message, "lake."), EXCLUDED).first().value


@pytest.mark.parametrize(
    "text",
    [
        "not json secret", '{"payload":null}', '{"payload":{"after":["secret"]}}', '{"payload":{"after":"secret"}}', "[1]", "",
        '{"payload":{"op":"c","after":{"id":1,"secret":"s"', '{"op":"c","after":{"secret":"s"}}',
    ],
)
def test_unreadable_texts_land_as_their_digest_only(spark, text):
    found = json.loads(exclude(spark, text))
    assert found["unreadable"]["length"] == len(text) and len(found["unreadable"]["sha256"]) == 64 and len(found) == 1


def test_escaped_names_and_other_tables(spark):
    escaped = '{"payload":{"op":"c","after":{"s\\u0065cret":"s","id":2}}}'
    assert json.loads(exclude(spark, escaped)) == {"payload": {"op": "c", "after": {"id": 2}}}
    for table in ("others", "empty"):
        assert exclude(spark, ' {"payload": {"after": {"secret": 1}}}', table) == ' {"payload": {"after": {"secret": 1}}}'


def test_password_hashes_never_land(spark, folder, lake):
    users = [{**row, "password_hash": "0123abcd"} for row in lake["usuarios"]]
    send(spark, f"{folder}/topics", {**lake, "usuarios": users})
    paths = finance.Lake(*(f"{folder}/{n}" for n in ("raw", "checkpoint", "state", "curated", "published")))
    finance.land(events.file_events(spark, f"{folder}/topics"), "lake.", paths)
    raw = spark.read.parquet(paths.raw)
    assert raw.filter("value LIKE '%password%' OR value LIKE '%0123abcd%'").isEmpty() and raw.count() == sum(map(len, lake.values()))
    assert sorted(finance.state_of(finance.raw_log(spark, paths), "usuarios").columns)[2:] == sorted(finance.SOURCE["usuarios"].columns)
