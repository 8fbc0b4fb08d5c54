from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from ledgerlake.llm import centroid_clusters as c

SCHEMA = "vec_id long, embedding array<float>, id string, x long, dots string, cluster string, distance string, label int"
HOW = c.Clustering(size=3, clusters=5, rounds=4)


def plain(rows, how):
    """Cluster, distance and final centroids by Python's whole numbers."""
    kept = [
        (i, tuple(math.floor(how.scale * x) for x in v))
        for i, v in rows
        if v is not None and len(v) == how.size and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = sorted((hashlib.sha256(f"{how.seed}{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in named[: how.clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), k) for k, m in enumerate(centroids)) for _, v in kept]

    for _ in range(how.rounds):
        found = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, at) in zip(kept, found) if at == k]
            if own:
                centroids[k] = tuple(sum(column) // len(own) for column in zip(*own))
    found = assign()
    total = sum(d for d, _ in found)
    rows = []
    for (i, _), (d, k) in zip(kept, found):
        inertia = sum(e for e, m in found if m == k)
        rows.append((i, k, d, inertia, total, hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()))
    return sorted(rows, key=repr)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "a", 1, "b", "c", "d", 2) for i, v in rows], SCHEMA).repartition(parts)


def vectors(seed, count, size=3):
    draw = random.Random(seed)
    rows = [(i, [draw.choice([draw.gauss(0, 1), draw.randrange(-2, 3) / 2]) for _ in range(size)]) for i in range(count)]
    return [(i, np.float32(v).astype(float).tolist()) for i, v in rows]


ODD = [
    (100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, 2.0, 3.0, 4.0]), (104, [1.0, None, 2.0]), (105, [float("nan"), 0.0, 0.0]),
    (106, [float("inf"), 0.0, 0.0]), (None, [0.5, 0.5, 0.5]), (None, None), (3, [0.25, 0.25, 0.25]), (3, [0.25, 0.25, 0.25]),
    (107, [-0.001, -0.0, 0.0]),
]


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_clustering(spark, seed):
    rows = vectors(seed, 60) + ODD
    got = sorted((tuple(r) for r in c.summarise(table(spark, rows), HOW).collect()), key=repr)
    assert got == plain(rows, HOW)


def test_ties_take_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(i, [0.0, 0.0, 0.0]) for i in range(6)] + [(9, [4.0, 0.0, 0.0])]
    got = sorted((tuple(r) for r in c.summarise(table(spark, rows), HOW).collect()), key=repr)
    assert got == plain(rows, HOW)
    assert {r[1] for r in got if r[2] == 0 and r[0] < 6} == {min(r[1] for r in got if r[0] < 6)}


def test_fewer_vectors_than_clusters_none_and_no_rows(spark):
    few = [(1, [1.0, 1.0, 1.0]), (2, [2.0, 1.0, 1.0])]
    assert sorted(tuple(r) for r in c.summarise(table(spark, few), HOW).collect()) == plain(few, HOW)
    assert c.summarise(table(spark, few).limit(0), HOW).collect() == []
    unusable = c.summarise(table(spark, [(1, None), (2, [1.0])]), HOW)
    assert unusable.collect() == []
    assert unusable.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_a_hot_cluster_and_many_partitions(spark):
    rows = vectors(7, 30) + [(1000 + i, [0.125, 0.25, 0.5]) for i in range(300)]
    got = sorted((tuple(r) for r in c.summarise(table(spark, rows, 9), HOW).collect()), key=repr)
    assert got == plain(rows, HOW)


def test_kept_dot_products_equal_products_computed_anew(spark):
    rows = vectors(11, 40)
    kept = c.integer_vectors(table(spark, rows), HOW, "vec_id", "embedding")
    first = c.start_centroids(kept, HOW)
    state = c.advance(kept, first * 0, first)
    second = c.moved(state, first)
    assert (second != first).any()
    for row in c.advance(state, first, second).collect():
        assert row.dots == [sum(a * int(b) for a, b in zip(row.x, m)) for m in second]


def test_components_too_large_for_whole_distances_stop_the_run(spark):
    with pytest.raises(Exception, match="leave 64 bits"):
        c.summarise(table(spark, [(1, [1e20, 0.0, 0.0])]), HOW)
