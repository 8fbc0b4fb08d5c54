from __future__ import annotations

from pathlib import Path

import numpy as np
import pytest

from ledgerlake.llm import token_shards as s
from tests.llm.conftest import PROSE

LAYOUT = s.Layout(length=64, shard_bytes=4096, least_shards=3)


@pytest.fixture(scope="module")
def vocabulary():
    return Path(s.VOCABULARY).read_bytes()


@pytest.mark.parametrize("domain", [1, 2, 3, 5, 16, 100, 257])
def test_feistel_permutes_and_goes_back(domain):
    places = [s.feistel(i, domain, "k") for i in range(domain)]
    assert sorted(places) == list(range(domain))
    assert [s.feistel(p, domain, "k", backward=True) for p in places] == list(range(domain))
    assert domain < 16 or places != [s.feistel(i, domain, "other") for i in range(domain)]


def test_texts_survive_encoding(vocabulary):
    for text in (PROSE, "é ü 漢字 \U0001f600 \n\n  \t x", " " * 3000, "a" * 3000, "<|endoftext|>"):
        ids = s.encode(text, vocabulary)
        assert s.END not in ids
        assert s.decode(np.frombuffer(ids.tobytes(), dtype=s.ID), vocabulary) == text
    long = PROSE * 4000
    assert len(long) > s.PIECE_CHARS
    assert s.decode(np.frombuffer(s.encode(long, vocabulary).tobytes(), dtype=s.ID), vocabulary) == long


@pytest.mark.parametrize("size", [1, 2, 7, 50])
def test_cut_texts_have_the_ids_of_the_whole(vocabulary, size):
    encoder = s._encoder(vocabulary)
    odd = " it's  été 12 345  x\n\n\ty  !? ²³ 漢字 😀  don't 'll \u00a0z  9 a   b "
    for text in (PROSE, odd, odd * 5, "a" * 200, " " * 90 + "q", ""):
        parts = list(s.pieces(text, size))
        assert "".join(parts) == text
        assert [i for part in parts for i in encoder.encode_ordinary(part)] == encoder.encode_ordinary(text)


def test_a_long_text_has_the_ids_of_the_whole(vocabulary):
    text = (PROSE + " née 1234 ") * 2600
    assert len(text) > s.PIECE_CHARS + 100_000 and len(list(s.pieces(text))) == 2
    assert list(s.encode(text, vocabulary)) == s._encoder(vocabulary).encode_ordinary(text)


def test_round_trip(spark, odd, vocabulary, folder):
    odd.write.parquet(folder + "/odd")
    documents = spark.read.parquet(folder + "/odd")
    index = s.write_shards(documents, layout=LAYOUT, folder=f"file://{folder}/shards")
    slots = {r.slot: r for r in s.with_slots(index).collect()}
    files = s.shard_table(index)
    back = {r.slot: r for r in s.read_shards(files, LAYOUT).collect()}
    assert sorted(slots) == sorted(back) == list(range(len(slots)))
    assert all(slots[k].crc32 == back[k].crc32 for k in slots)
    for row in files.collect():
        data = Path(row.path.removeprefix("file://")).read_bytes()
        assert len(data) == row.n_sequences * LAYOUT.stride
        at = slots[row.first_slot].position * LAYOUT.stride
        assert data[at : at + LAYOUT.stride] == bytes(back[row.first_slot].ids)
    # Every text stands in the shards: all ids and end marks are there, and each sequence names its documents.
    texts = [r.text for r in documents.collect() if r.text]
    want = sorted(i for t in texts for i in [*s.encode(t, vocabulary), s.END])
    got = sorted(i for k, r in back.items() for i in np.frombuffer(r.ids, dtype=s.ID)[: slots[k].n_tokens].tolist())
    assert got == want
    named = {d for r in slots.values() for d in r.doc_ids}
    assert named == {r.doc_id for r in documents.collect() if r.text}
    middle = [r.slot for r in s.read_shards(files, LAYOUT, 5, 17).collect()]
    assert sorted(middle) == list(range(5, 17))


def test_order_is_the_keys(spark, odd, folder):
    odd.write.parquet(folder + "/odd")
    documents = spark.read.parquet(folder + "/odd")

    def order(key):
        index = s.write_shards(documents, layout=s.Layout(64, 4096, 3, key))
        return [r.crc32 for r in s.with_slots(index).orderBy("slot").collect()]

    first, again, other = order("a"), order("a"), order("b")
    assert first == again and sorted(first) == sorted(other) and first != other


def test_empty_table(spark, nothing):
    index = s.write_shards(nothing)
    assert index.collect() == [] and s.with_slots(index).collect() == [] and s.read_shards(s.shard_table(index)).collect() == []
