from __future__ import annotations

import datetime as dt
import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlake.functions import wire
from ledgerlake.operators import changes
from ledgerlake.spec import TableSpec
from tests.conftest import rows

SPEC = TableSpec(
    "entries",
    "id BIGINT, owner INT, amount DECIMAL(12,2), note STRING, active BOOLEAN, born DATE, at TIMESTAMP, gone TIMESTAMP",
    soft_delete="gone",
)
RAW = (
    "table STRING, ingest_date DATE, topic STRING, partition INT, offset BIGINT, log_ts TIMESTAMP, "
    "key STRING, value STRING"
)
DAY = dt.date(2026, 1, 1)
NOON = dt.datetime(2026, 1, 1, 12)


def row(id_, amount="10.00", **over):
    values = {
        "id": id_, "owner": 1, "amount": amount, "note": "n", "active": 1, "born": 20000,
        "at": 1767268800000, "gone": None,
    }
    return {**values, **over}


def event(op, before=None, after=None, **extra):
    return json.dumps({"payload": {"op": op, "before": before, "after": after, **extra}})


def log(spark, *messages, table="entries"):
    """Messages as ``value`` or ``(partition, offset, value)``; offsets count up by default."""
    lines = []
    for position, message in enumerate(messages):
        partition, offset, value = message if isinstance(message, tuple) else (0, position, message)
        lines.append((table, DAY, f"t.{table}", partition, offset, NOON, "k", value))
    return spark.createDataFrame(lines, RAW)


def state(spark, *messages, mode="strict", columns=("id", "amount")):
    return rows(changes.current_state(log(spark, *messages), SPEC, mode), *columns)


def test_snapshot_create_and_update_are_upserts(spark):
    messages = [
        event("r", after=row(1, "1.00")),
        event("c", after=row(2, "2.00")),
        event("u", row(2, "2.00"), row(2, "2.50")),
    ]
    assert state(spark, *messages) == [(1, Decimal("1.00")), (2, Decimal("2.50"))]


def test_soft_deleted_rows_stay_in_the_state(spark):
    messages = [event("c", after=row(1)), event("u", row(1), row(1, gone=1767268800000))]
    assert state(spark, *messages, columns=("id", "gone")) == [(1, NOON)]


def test_delete_removes_and_tombstone_is_ignored(spark):
    assert state(spark, event("c", after=row(1)), event("d", before=row(1)), None) == []


def test_delete_is_dropped_after_the_last_event_is_chosen(spark):
    """Dropping deletes first would bring the row back."""
    messages = [event("c", after=row(1)), event("u", row(1), row(1, "5.00")), event("d", before=row(1))]
    assert state(spark, *messages) == []


def test_recreated_row_is_alive(spark):
    messages = [event("c", after=row(1)), event("d", before=row(1)), event("c", after=row(1, "7.00"))]
    assert state(spark, *messages) == [(1, Decimal("7.00"))]


def test_order_is_the_offset_not_the_arrival(spark):
    late_first = [(0, 9, event("u", row(1), row(1, "9.00"))), (0, 3, event("c", after=row(1, "3.00")))]
    assert state(spark, *late_first) == [(1, Decimal("9.00"))]


def test_equal_offsets_of_two_partitions_are_decided_by_the_partition(spark):
    messages = [(0, 5, event("c", after=row(1, "1.00"))), (1, 5, event("c", after=row(1, "2.00")))]
    assert state(spark, *messages) == state(spark, *reversed(messages)) == [(1, Decimal("2.00"))]


def test_sequence_is_a_parameter(spark):
    messages = [(0, 5, event("c", after=row(1, "1.00"))), (1, 4, event("c", after=row(1, "2.00")))]
    found = changes.current_state(log(spark, *messages), SPEC, sequence=("partition", "offset"))
    assert rows(found, "amount") == [(Decimal("2.00"),)]


def test_key_is_compared_by_value(spark):
    messages = [event("c", after=row("7", "1.00")), event("u", row("7"), row("07", "2.00"))]
    assert state(spark, *messages) == [(7, Decimal("2.00"))]


def test_lineage_columns(spark):
    found = changes.current_state(log(spark, event("c", after=row(1)), event("u", row(1), row(1))), SPEC)
    assert rows(found, "_last_offset", "_last_op") == [(1, "u")]


def test_unknown_columns_are_dropped_and_missing_ones_are_null(spark):
    short = {"id": 1, "amount": "1.00", "password": "x"}
    found = changes.current_state(log(spark, event("c", after=short)), SPEC)
    assert "password" not in found.columns
    assert rows(found, "id", "note", "active") == [(1, None, None)]


def test_only_the_table_of_the_spec(spark):
    other = log(spark, event("c", after=row(9)), table="other")
    found = changes.current_state(log(spark, event("c", after=row(1))).union(other), SPEC)
    assert rows(found, "id") == [(1,)]


BROKEN = [
    '{"payload":{"op":"c"',
    '{"payload":null}',
    "[]",
    event("c", after={"note": "no key"}),
    json.dumps({"payload": {"before": None, "after": row(1)}}),
]


@pytest.mark.parametrize("message", BROKEN)
def test_broken_messages_do_not_become_rows_nor_hide_one(spark, message):
    messages = [event("c", after=row(1, "1.00")), message]
    assert state(spark, *messages) == [(1, Decimal("1.00"))]
    assert changes.quarantined(log(spark, *messages), SPEC).count() == 1


def test_strict_mode_stops_at_a_bad_value(spark):
    with pytest.raises(PySparkException):
        state(spark, event("c", after=row(1, "ten")))


@pytest.mark.parametrize("bad", [{"amount": "99999999999.99"}, {"amount": "ten"}, {"born": "yesterday"}, {"owner": "x"}])
def test_quarantine_mode_diverts_a_bad_value(spark, bad):
    messages = [event("c", after=row(1, **bad)), event("c", after=row(2))]
    assert state(spark, *messages, mode="quarantine", columns=("id",)) == [(2,)]
    found = changes.quarantined(log(spark, *messages), SPEC)
    assert rows(found, "offset", "reason") == [(0, f"bad value: {next(iter(bad))}")]


def test_quarantine_mode_keeps_the_last_good_version(spark):
    messages = [
        event("c", after=row(1, "5.00")), event("u", after=row(1, "ten")), event("c", after=row(2, "7.00")),
        event("u", after=row(2, "x")), event("d", before=row(2, "x")), event("c", after=row(3, "bad")),
    ]
    assert state(spark, *messages, mode="quarantine", columns=("id", "amount")) == [(1, Decimal("5.00"))]
    assert rows(changes.quarantined(log(spark, *messages), SPEC), "offset") == [(1,), (3,), (5,)]


@pytest.mark.parametrize("by", [[], ["kind"]])
def test_samples_merge_and_repeat(spark, by):
    table = spark.range(60).select(F.col("id"), (F.col("id") % 3).alias("kind"))
    sample = rows(changes.sample_rows(table.repartition(7), ["id"], 4, by))
    parts = [changes.sample_rows(table.filter(f"id % 2 = {n}"), ["id"], 4, by) for n in (0, 1)]
    assert sample == rows(changes.sample_rows(parts[0].unionByName(parts[1]), ["id"], 4, by))
    order = sorted(range(60), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    groups = [[i for i in order if i % 3 == k][:4] for k in range(3)] if by else [order[:4]]
    assert {r[0] for r in sample} == {i for g in groups for i in g}


def test_a_deleted_row_is_not_quarantined_for_its_old_values(spark):
    assert changes.quarantined(log(spark, event("d", before=row(1, "ten")), None), SPEC).isEmpty()


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("12", "int", 12),
        ("12345678901", "bigint", 12345678901),
        ("1.235", "decimal(12,2)", Decimal("1.24")),
        ("-1.235", "decimal(12,2)", Decimal("-1.24")),
        ("true", "boolean", True),
        ("TRUE", "boolean", True),
        ("1", "boolean", True),
        ("0", "boolean", False),
        ("false", "boolean", False),
        (None, "boolean", None),
        ("20000", "date", dt.date(2024, 10, 4)),
        ("-1", "date", dt.date(1969, 12, 31)),
        ("2024-10-04", "date", dt.date(2024, 10, 4)),
        (None, "date", None),
        ("1767268800000", "timestamp", NOON),
        ("-1000", "timestamp", dt.datetime(1969, 12, 31, 23, 59, 59)),
        ("x", "string", "x"),
    ],
)
@pytest.mark.parametrize("strict", [True, False])
def test_wire_types(spark, text, kind, value, strict):
    from pyspark.sql import functions as F

    target = TableSpec("t", f"c {kind}").schema["c"].dataType
    frame = spark.createDataFrame([(text,)], "c STRING").select(wire.decode(F.col("c"), target, strict).alias("c"))
    assert frame.schema["c"].dataType == target
    assert frame.first()["c"] == value


def test_envelope_is_narrow_unless_asked(spark):
    narrow = SPEC.envelope()["payload"].dataType
    assert narrow["before"].dataType.fieldNames() == ["id"]
    assert SPEC.envelope("all")["payload"].dataType["before"].dataType.fieldNames() == SPEC.columns


def test_describe_changes(spark):
    source = {"source": {"table": "entries"}}
    messages = [
        event("u", row(1, "1.00"), row(1, "2.00", note=None), **source),
        event("c", after={"id": 2, "note": "x"}, **source),
        event("d", before={"id": 3}, **source),
        event("r", after={"id": 4}, **source),
        event("t", **source),
        None,
    ]
    found = {r["offset"]: r for r in changes.describe_changes(log(spark, *messages)).collect()}
    assert set(found) == {0, 1, 2, 3, 4}
    assert found[0]["changes"] == {"amount": "1.00 -> 2.00", "note": "n -> None"}
    assert (found[1]["operation"], found[1]["changes"]) == ("INSERT", {"id": "2", "note": "x"})
    assert (found[2]["operation"], found[2]["row_key"]) == ("DELETE", "3")
    assert (found[3]["operation"], found[3]["changes"]) == ("SNAPSHOT", None)
    assert (found[4]["operation"], found[4]["row_key"]) == ("t", "?")


def test_change_counts(spark):
    messages = [event("c", after=row(1)), event("c", after=row(2)), event("d", before=row(1)), None]
    assert rows(changes.change_counts(log(spark, *messages))) == [
        ("TOTAL", None, 3), ("entries", "DELETE", 1), ("entries", "INSERT", 2),
    ]


def test_encoding_round_trip(spark):
    from pyspark.sql import functions as F

    data = [(1, 7, Decimal("1.50"), None, True, DAY, NOON, None), (2, None, None, 'say "x"', None, None, None, NOON)]
    table = spark.createDataFrame(data, SPEC.schema)
    after = F.struct(*[wire.encode(F.col(f.name), f.dataType).alias(f.name) for f in SPEC.schema.fields])
    created = changes.Event(F.lit(NOON), "c", after=after)
    encoded = changes.change_messages(table, SPEC.name, [created], F.lit(0), F.col("id"))
    value = json.loads(encoded.filter("key = '1'").first()["value"])
    assert value["payload"]["before"] is None and value["payload"]["after"]["note"] is None
    back = changes.current_state(encoded, SPEC).select(*SPEC.columns)
    assert rows(back) == rows(table)


@pytest.mark.parametrize("partitions", [1, 2, 3])
def test_messages_have_places_of_their_own(spark, partitions):
    from pyspark.sql import functions as F

    rows_ = spark.range(40)
    image, key, at = F.struct("id"), F.col("id"), F.lit(NOON)
    events = [
        changes.Event(at, "c", after=image),
        changes.Event(at, "u", image, image, happens=key % 3 == 0),
        changes.Event(at, "d", before=image, happens=key % 4 == 1),
        changes.Event(at, happens=key % 4 == 1),
        changes.Event(at, text=F.lit("broken"), happens=key == 7),
    ]
    log_ = changes.change_messages(rows_, "t", events, key % partitions, key * len(events), topic_prefix="p.")
    got = [(r.partition, r.offset, r.key, r.value) for r in log_.collect()]
    assert len({(p, o) for p, o, _, _ in got}) == len(got) == 40 + 14 + 10 + 10 + 1
    of_nine = [(o, v and json.loads(v)["payload"]["op"]) for _, o, k, v in sorted(got) if k == "9"]
    assert of_nine == [(45, "c"), (46, "u"), (47, "d"), (48, None)]
    assert {v for _, o, k, v in got if k == "7" and o == 39} == {"broken"}
