from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import ngram_join as j
from ledgerlake.llm.common import hash_filter, where_in_filter
from tests.llm.conftest import PROSE, low_words


def shingles(text, size):
    tokens = low_words(text)
    if not tokens:
        return frozenset()
    return frozenset(tuple(tokens[i : i + size]) for i in range(max(1, len(tokens) - size + 1)))


def plain_components(rows, size, percent):
    """Per row (id, set size, least id reachable), by comparing all pairs."""
    sets = [shingles(text, size) for _, text in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                label[max(root(a), root(b))] = min(root(a), root(b))
    least: dict[int, int | None] = {}
    for i, (name, _) in enumerate(rows):
        known = [x for x in (least.get(root(i)), name) if x is not None]
        least[root(i)] = min(known) if known else None
    return sorted([(name, len(sets[i]), least[root(i)] if sets[i] else name) for i, (name, _) in enumerate(rows)], key=repr)


def family(draw, base, count, changes):
    """Variants of a text, some words replaced in each."""
    made = []
    for _ in range(count):
        tokens = list(base)
        for _ in range(draw.randrange(0, changes)):
            tokens[draw.randrange(len(tokens))] = f"w{draw.randrange(10_000)}"
        made.append(" ".join(tokens))
    return made


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    texts = []
    for _ in range(6):
        base = [f"v{draw.randrange(300)}" for _ in range(draw.choice([30, 90, 200]))]
        texts += family(draw, base, 14, draw.choice([3, 8, 12]))
    passage = " ".join(f"p{i}" for i in range(50))  # shared by texts that are no copies
    texts += [passage + " " + " ".join(f"q{n}x{i}" for i in range(draw.choice([4, 40]))) for n in range(20)]
    texts += ["one two", "ONE two", "one two three", "one", "", None, PROSE, PROSE, PROSE.upper()]
    made = [(i * 3 % 311, t) for i, t in enumerate(texts)]
    return made + [(None, PROSE), (None, texts[0]), (7, "used twice " + PROSE), (7, None)]


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_equals_all_pairs(spark, rows, size, percent):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted([tuple(r) for r in j.near_copies(frame, j.Join(size, percent)).collect()], key=repr)
    assert got == plain_components(rows, size, percent)


def test_variants_below_the_threshold_are_dropped_before_their_sets_are_read(spark, monkeypatch):
    draw = random.Random(5)
    made = []
    for name in range(240):  # one word replaced: alike at the same place (0.94), else just not (0.885)
        tokens = [f"b{i}" for i in range(100)]
        tokens[2 + 3 * draw.randrange(32)] = f"x{name}"
        made.append((name, " ".join(tokens)))
    compared, keep = [], j.Workspace.keep

    def counted(space, frame, name):
        table = keep(space, frame, name)
        if name == "plausible-pairs":
            compared.append(table.count())
        return table

    monkeypatch.setattr(j.Workspace, "keep", counted)
    frame = spark.createDataFrame(made, "doc_id long, text string")
    got = sorted([tuple(r) for r in j.near_copies(frame, j.Join(3, 90)).collect()], key=repr)
    assert got == plain_components(made, 3, 90)
    assert len({r[2] for r in got}) > 20 and sum(compared) < 8_000  # of 28,680 pairs


def test_signatures_differ_in_no_more_bits_than_sets_in_grams(spark):
    draw = np.random.default_rng(2)
    for n, more in ((3, 1), (60, 5), (62, 9), (130, 20), (3000, 400)):  # some pairs of different lengths
        grams = np.unique(draw.integers(0, 2**64, n + 2 * more, dtype=np.uint64))
        sets = [np.sort(grams[:-more]), np.sort(grams[more + 1 :]), grams[:2]]
        rows = [(a, b, [int(x) for x in j._signature(sets[a])], [int(x) for x in j._signature(sets[b])]) for a in range(3) for b in range(3)]
        frame = spark.createDataFrame(rows, "a int, b int, x array<long>, y array<long>")
        for r in frame.select("a", "b", j._unlike_bits(F.col("x"), F.col("y")).alias("unlike")).collect():
            differ = len(np.setxor1d(sets[r.a], sets[r.b]))
            assert r.unlike <= differ and (r.unlike > 0 or not differ or 2 in (r.a, r.b))


def test_odd_rows_and_one_of_each(spark, odd, nothing):
    pairs = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted([tuple(r) for r in j.near_copies(odd).collect()], key=repr)
    assert got == plain_components(pairs, 5, 80)
    kept = j.keep_one(odd)
    assert kept.columns == odd.columns
    components = {r[2] for r in plain_components([p for p in pairs if low_words(p[1])], 5, 80)}
    with_words = [r for r in kept.collect() if low_words(r.text)]
    assert sorted(r.doc_id for r in with_words) == sorted(components)
    assert sum(not low_words(r.text) for r in kept.collect()) == sum(not low_words(t) for _, t in pairs)
    assert j.near_copies(nothing).collect() == [] and j.keep_one(nothing).collect() == []


def test_codes_order_and_fragments():
    level = np.zeros((j.SKETCH_ROWS, j.SKETCH_WIDTH), dtype=np.uint16)
    grams = np.unique(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    order = j.Order(level, np.array([1 << 46, 1 << 47], dtype=np.uint64))
    assert (np.diff(order.codes(grams).astype(object)) >= 0).all()
    assert set(order.fragments(grams)) == {0, 1, 2}


def test_hash_filter_has_no_false_negatives(spark):
    ids = spark.range(-500, 500).selectExpr("id", "xxhash64(id) AS h")
    some = ids.where("id % 5 = 0")
    bits = hash_filter(some, "h")
    inside = {r.id for r in where_in_filter(ids, "h", bits).collect()}
    outside = {r.id for r in where_in_filter(ids, "h", bits, inside=False).collect()}
    assert {r.id for r in some.collect()} <= inside and not inside & outside and len(inside | outside) == 1000
