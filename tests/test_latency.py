from __future__ import annotations

import json
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import backlog, latency
from ledgerlake.sources import oplog
from tests.conftest import rows
from tests.test_changes import event, log

OPS = "row_id BIGINT, seq BIGINT, op STRING, sent_ms BIGINT, answered_ms BIGINT"
PAIRS = "sent_to_emit_ms BIGINT, answer_to_emit_ms BIGINT, source_to_emit_ms BIGINT"


def emitted(op, id_, at, committed=None):
    side = {"before": {"id": id_}} if op == "d" else {"after": {"id": id_}}
    return event(op, **side, ts_ms=at, source={"table": "entries", "ts_ms": committed})


def test_operations_pair_with_events_by_ordinal(spark):
    messages = [
        emitted("r", 1, 5), emitted("c", 1, 110, 100), emitted("c", 9, 1), emitted("u", 1, 230, 225),
        None, emitted("d", 1, 350), '{"payload":{"op":"u","after":{"id":"x"}}}',
    ]
    operations = [(1, 0, "create", 100, 120), (1, 1, "update", 200, 240), (1, 2, "delete", 300, 340), (2, 3, "create", 5, 6)]
    calls = spark.createDataFrame(operations, OPS)
    pairs = latency.pair_operations(calls, latency.live_events(log(spark, *messages), "entries"))
    assert rows(pairs, "row_id", "op", "event_op", "sent_to_emit_ms", "answer_to_emit_ms", "source_to_emit_ms") == [
        (1, "create", "c", 10, -10, 10), (1, "delete", "d", 50, 10, None), (1, "update", "u", 30, -10, 5),
        (2, "create", None, None, None, None),
    ]
    assert rows(latency.unmatched(pairs)) == [(2, 1, "create")]


@pytest.mark.parametrize("crowd, crowds", [(1000, 10), (3, 1), (3, 2), (3, 10), (0, 10)])
def test_crowded_rows_pair_as_the_others_do(spark, crowd, crowds):
    """Rows with 0 to 9 operations and up to 12 events, equal clocks and offsets included, against a plain pairing."""
    draw = random.Random(crowd * 10 + crowds)
    calls, messages = [], []
    for row_id in range(12):
        calls += [(row_id, seq, "op", draw.randrange(4), 100) for seq in range(row_id % 10)]
        messages += [(row_id, draw.randrange(6), draw.randrange(3), i, "u", draw.randrange(500), 7) for i in range(draw.randrange(13))]
    events = spark.createDataFrame(
        messages, "row_id BIGINT, offset BIGINT, partition INT, i INT, event_op STRING, emitted_ms BIGINT, source_ms BIGINT"
    ).withColumn("log_ts", F.timestamp_millis("i"))
    pairs = latency.pair_operations(spark.createDataFrame(calls, OPS), events.drop("i"), crowd, crowds)
    wanted = []
    for row_id in range(12):
        own = sorted(m[1:] for m in messages if m[0] == row_id)
        for i, call in enumerate(sorted((c[3], c[1]) for c in calls if c[0] == row_id)):
            wanted.append((row_id, i + 1, own[i][4] - call[0] if i < len(own) else None, i < len(own)))
    assert rows(pairs, "row_id", "ordinal", "sent_to_emit_ms", "has_event") == sorted(wanted, key=repr)


def test_surplus_events_go_before_the_shuffle_and_the_log_is_parsed_once(spark):
    calls = spark.createDataFrame([(1, 0, "create", 1, 2)], OPS)
    pairs = latency.pair_operations(calls, latency.live_events(log(spark, emitted("c", 1, 5)), "entries"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("from_json") == 1 and plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("n", [1, 2, 3, 15, 20, 21, 100])
def test_summary_uses_nearest_rank(spark, n):
    values = [(i * 37) % 101 - 20 for i in range(n)]
    pairs = spark.createDataFrame([(v, None, v) for v in values], PAIRS)
    found = {r["measure"]: tuple(r)[1:] for r in latency.latency_summary(pairs, clock_skew_ms=7).collect()}
    ordered = sorted(values)
    p95 = ordered[max(0, math.ceil(0.95 * n) - 1)]
    wanted = (n, ordered[0], round(statistics.median(values)), p95, ordered[-1])
    assert found["sent_to_emit"] == wanted
    assert found["sent_to_emit_corrected"][1] == ordered[0] - 7
    assert "answer_to_emit" not in found


def test_operation_log_file(spark, folder):
    document = {
        "api": "x",
        "usuarioId": 4,
        "operaciones": [
            {"op": "crear", "egresoId": 7, "enviado": "2026-10-14T20:01:02.345Z", "respondido": "2026-10-14T20:01:02.500Z", "http": 201},
            {"op": "eliminar", "egresoId": 7, "enviado": "2026-10-14T20:01:03Z", "respondido": "2026-10-14T20:01:04Z", "http": 500},
        ],
    }
    with open(f"{folder}/log.json", "w") as file:
        json.dump(document, file, indent=2)
    read = oplog.read_operation_log(spark, folder)
    assert read.count() == 2
    accepted = oplog.accepted(read)
    assert rows(accepted, "row_id", "op", "sent_ms", "answered_ms") == [(7, "crear", 1792008062345, 1792008062500)]


@pytest.mark.parametrize("code, kept", [(199, False), (200, True), (299, True), (300, False), (None, False)])
def test_success_codes(spark, code, kept):
    frame = spark.createDataFrame([(code,)], "http INT")
    assert oplog.accepted(frame).isEmpty() is not kept


def test_backlog(spark):
    offsets = "topic STRING, partition INT, next_offset BIGINT"
    available = spark.createDataFrame(
        [("a", 0, 10), ("a", 1, 5), ("new", 0, 3), ("ahead", 0, 2), ("empty", 0, 0)], offsets
    )
    consumed = spark.createDataFrame([("a", 0, 10), ("a", 1, 2), ("ahead", 0, 9), ("gone", 0, 1)], offsets)
    assert rows(backlog.offset_backlog(available, consumed)) == [("a", 1, 3), ("new", 0, 3)]


def test_landed_offsets_come_from_landed_rows(spark):
    landed = log(spark, (0, 4, "x"), (0, 2, "x"), (1, 0, None))
    assert rows(backlog.landed_offsets(landed)) == [("t.entries", 0, 5), ("t.entries", 1, 1)]


def test_nothing_to_summarise(spark):
    empty = spark.createDataFrame([], PAIRS)
    assert latency.latency_summary(empty).isEmpty()
