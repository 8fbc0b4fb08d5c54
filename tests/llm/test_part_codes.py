from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from ledgerlake.llm import part_codes as p

SCHEMA = "vec_id long, embedding array<double>, label int, id string, code string, error string, x string, same int"
HOW = p.Coding(parts=2, entries=6, rounds=3, block=2)


def plain(rows, how):
    kept = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    longest = max([len(v) for _, v, _ in rows if v is not None], default=0)
    length = max(1, -(-longest // how.parts)) * how.parts
    width = length // how.parts
    whole = [(i, [math.floor(how.scale * x) for x in v] + [0] * (length - len(v)), g) for i, v, g in kept]
    first = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[: how.entries]
    cut = lambda v, k: tuple(v[k * width : (k + 1) * width])
    books = [[cut(v, k) for _, v, _ in first] for k in range(how.parts)]

    def assign():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(cut(v, k), m)), e) for e, m in enumerate(books[k])) for k in range(how.parts)]
            for _, v, _ in whole
        ]

    for _ in range(how.rounds):
        found = assign()
        for k in range(how.parts):
            for e in range(len(books[k])):
                own = [cut(v, k) for (_, v, _), f in zip(whole, found) if f[k][1] == e]
                if own:
                    books[k][e] = tuple(sum(column) // len(own) for column in zip(*own))
    found = assign()
    digest = hashlib.sha256(",".join(str(x) for book in books for m in book for x in m).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    out = []
    for (i, _, g), f, error in zip(whole, found, errors):
        label = sum(e for e, (_, _, other) in zip(errors, whole) if other == g)
        out.append((i, "".join(f"{e:02x}" for _, e in f), error, label, digest))
    return sorted(out, key=repr)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, g, "a", "b", "c", "d", 1) for i, v, g in rows], SCHEMA).repartition(parts)


def vectors(seed, count, size):
    draw = random.Random(seed)
    return [
        (i, [draw.choice([draw.gauss(0, 1), draw.randrange(-2, 3) / 2]) for _ in range(size)], draw.choice([None, 1, 2]))
        for i in range(count)
    ]


ODD = [
    (100, None, 1), (101, [], 1), (102, [1.0, None, 2.0], 2), (103, [float("nan")], None), (104, [float("-inf"), 1.0], 1), (None, None, None),
    (None, [0.5, 0.5], None), (3, [0.25, 0.25], 3), (3, [0.25, 0.25], 3), (105, [-0.0001], None),
]


@pytest.mark.parametrize("size", [1, 4, 6, 10])
def test_equals_plain_coding(spark, size):
    rows = vectors(size, 40, size) + ODD
    got = sorted((tuple(r) for r in p.summarise(table(spark, rows), HOW).collect()), key=repr)
    assert got == plain(rows, HOW)


def test_few_vectors_no_vectors_no_rows(spark):
    few = [(1, [1.0, 1.0], None), (2, [2.0, 1.0], 5)]
    assert sorted(tuple(r) for r in p.summarise(table(spark, few), HOW).collect()) == plain(few, HOW)
    for rows in (few[:0], [(1, None, 1), (2, [None], 1)]):
        none = p.summarise(table(spark, few).limit(0) if not rows else table(spark, rows), HOW)
        assert none.collect() == [] and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_a_hot_label_over_many_partitions(spark):
    rows = vectors(5, 20, 4) + [(1000 + i, [0.125, 0.25, 0.5, 0.5], None) for i in range(200)]
    got = sorted((tuple(r) for r in p.summarise(table(spark, rows, 9), HOW).collect()), key=repr)
    assert got == plain(rows, HOW)


def test_transform_keeps_distances_and_orders_by_sign_changes():
    draw = np.random.default_rng(2)
    rows, others = draw.integers(-50, 50, (20, 11)), draw.integers(-50, 50, (20, 11))
    a, b = p.transformed(rows), p.transformed(others)
    assert a.shape == (20, 16) and (((a - b) ** 2).sum(axis=1) == 16 * ((rows - others) ** 2).sum(axis=1)).all()
    matrix = p.transformed(np.eye(16, dtype=np.int64)).T
    assert ((matrix[:, 1:] != matrix[:, :-1]).sum(axis=1) == np.arange(16)).all()


@pytest.mark.parametrize("block", [1, 2, 3, 4, 16, 40])
def test_early_elimination_finds_the_first_nearest_entry(block):
    draw = np.random.default_rng(block)
    for spread in (2, 5, 1000):
        rows, entries = draw.integers(-spread, spread + 1, (300, 13)), draw.integers(-spread, spread + 1, (40, 13))
        rows[:40], entries[20:25] = entries, entries[3:8]
        index, distance = p.nearest_entries(p.transformed(rows), p.transformed(entries), block)
        every = ((rows[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_codes_stand_for_entries(spark):
    rows = vectors(9, 30, 4)
    codes, books = p.compress(table(spark, rows), HOW)
    for row in p.restored(codes, books).collect():
        whole = [math.floor(1024 * x) for x in rows[row.id][1]]
        assert sum((a - b) ** 2 for a, b in zip(whole, row.x)) == row.error


def test_components_too_large_for_whole_distances_stop_the_run(spark):
    with pytest.raises(Exception, match="leave 64 bits"):
        p.summarise(table(spark, [(1, [1e20, 0.0], 1)]), HOW)
