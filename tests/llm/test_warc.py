from __future__ import annotations

import gzip
import hashlib
import io

import pytest

from ledgerlake.llm import warc as w

PAGES = [
    (1, "http://a/1", "x" * 1000), (2, "http://a/2", "x" * 1000), (3, None, "x" * 1000), (3, "http://b", "x" * 1000), (4, "http://a/4\nx%0A", "é" * 700),
    (5, "http://a/5", "short"), (6, "http://a/6", "short"), (7, "http://a/7", None), (None, "http://n", "x" * 1000), (8, "", "\r\n\r\n" + "y" * 300_000),
    (None, None, "z" * 2000), (None, None, "z" * 2000),
]


@pytest.fixture(scope="module")
def written(spark):
    frame = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, payload string").repartition(2)
    return w.write_archives(w.plan_records(frame, 1000), w.shared_uri(spark, "test"))


def test_round_trip(written):
    got = sorted([(r.id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in w.read_archives(written).collect()], key=repr)
    wanted = []
    for page, url, html in PAGES:
        data = (html or "").encode()
        revisit = html == "x" * 1000 and page != 3
        wanted.append((page, url, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert got == sorted(wanted, key=repr)


def test_payloads_come_back(written):
    texts = {r.id: r.payload for r in w.read_archives(written).collect() if r.record_type == "response" and r.id is not None}
    assert texts[4].decode() == "é" * 700 and texts[8].decode() == PAGES[9][2] and texts[7] == b""


def member(payload=b"hello", **changes):
    data = w.record_bytes(1, "u", payload, hashlib.sha1(payload).hexdigest(), "response", None)
    text = gzip.decompress(data)
    for old, new in changes.get("swap", []):
        assert old in text
        text = text.replace(old, new)
    return gzip.compress(text)


def test_records_are_found_at_their_offsets():
    parts = [member(bytes([65 + i]) * 70_000 * (i + 1)) for i in range(3)]
    records = list(w.read_records(io.BytesIO(b"".join(parts))))
    assert [r[-1] for r in records] == [0, len(parts[0]), len(parts[0]) + len(parts[1])]
    again = next(w.read_records(io.BytesIO(b"".join(parts)[records[2][-1] :])))
    assert again[6] == b"C" * 210_000


@pytest.mark.parametrize(
    "data",
    [
        member(swap=[(b"hello", b"hullo")]),
        member(swap=[(b"Content-Type: application", b"content-length: 3\r\nContent-Type: application")])[:60],
        member(swap=[(b"WARC/1.1", b"XARC/1.1")]),
        member() [:-12],
        b"not a gzip file at all",
        gzip.compress(gzip.decompress(member()) + b"more"),
    ],
)
def test_damage_is_reported(data):
    with pytest.raises(w.DamagedArchive):
        list(w.read_records(io.BytesIO(data)))


def test_empty_table(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    archives = w.write_archives(w.plan_records(frame, 1000), w.shared_uri(spark, "test"))
    assert archives.collect() == [] and w.read_archives(archives).collect() == []
