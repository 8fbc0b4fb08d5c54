"""Centroid clustering over integers that keeps what it has computed: an incremental distance matrix.

Vectors and centroids are integers, so ``|x - c|^2 = |x|^2 - 2 x.c + |c|^2`` is exact. Every vector keeps its
dot products with all centroids in a table. When a round moves the centroids, only the components that
changed are multiplied: ``x.c`` grows by the sum of ``x_j * (new c_j - old c_j)`` over the ``j`` where the
difference isn't zero. Then the nearest centroid is taken anew, the smaller number at ties. A centroid that stays
costs nothing, and the first round is the same step from centroids of zeros.

A round is one pass that writes the table anew (the one before goes once it stands) and one that sums components per
cluster: a task adds up what it reads, so one cluster may hold most vectors. What comes to the driver are
``clusters * (size + 1)`` sums, whatever the number of vectors; sums are decimals and can't overflow.

Defined results: vectors that are null, of another length, or hold a null or non-finite component are left out, so an
empty table or one without such vectors gives no row; repeated rows are vectors of their own; start vectors of equal
id are ordered by their components; a vector without id is clustered but starts no centroid; with fewer vectors than
clusters there are fewer clusters; components beyond ``MOST / scale`` stop the run, as a distance would leave 64 bits;
further columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import Workspace, bounded_batches
from ledgerlake.llm.vectors import as_lists, as_matrix, finite_vectors, floored

MOST = 1 << 27
WIDE = "decimal(38,0)"


@dataclass(frozen=True)
class Clustering:
    """Components of a vector, their scale, clusters, rounds, and what start ids are hashed with."""

    size: int = 64
    scale: int = 256
    clusters: int = 40
    rounds: int = 5
    seed: str = "2:"


def integer_vectors(vectors: DataFrame, how: Clustering, key: str, vector: str) -> DataFrame:
    """``id, x`` of the vectors that take part."""
    chosen = vectors.select(vectors[key].alias("id"), vectors[vector].alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, length, value = finite_vectors(batch.column(1))
            fits = length == how.size
            x = floored(value[np.repeat(fits, length)], how.scale, MOST).reshape(-1, how.size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row[fits])), as_lists(x, pa.int32())], names=["id", "x"]
            )

    return chosen.mapInArrow(run, f"id {chosen.schema['id'].dataType.simpleString()}, x array<int>")


def start_centroids(table: DataFrame, how: Clustering) -> np.ndarray:
    """The vectors whose hashed ids come first, in that order."""
    named = table.where("id IS NOT NULL").select(F.sha2(F.concat(F.lit(how.seed), F.col("id").cast("string")), 256).alias("h"), "x")
    first = named.orderBy("h", "x").limit(how.clusters).collect()  # one per cluster
    return np.array([row.x for row in first], dtype=np.int64).reshape(-1, how.size)


def nearest(x: np.ndarray, dots: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid, the smaller number at ties, and its squared distance."""
    distances = squares - 2 * dots
    cluster = distances.argmin(axis=1)
    return cluster, distances[np.arange(len(x)), cluster] + np.einsum("ij,ij->i", x, x)


def advance(state: DataFrame, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """``id, x, dots, cluster, distance`` once the centroids have moved.

    ``state`` has the dot products with the centroids ``before``; without such a column they are zeros.
    """
    count, size = after.shape
    moves = [(k, np.flatnonzero(after[k] != before[k])) for k in range(count)]
    moves = [(k, at, after[k, at] - before[k, at]) for k, at in moves if len(at)]
    squares = np.einsum("ij,ij->i", after, after)
    known = "dots" in state.columns
    chosen = state.select("id", "x", "dots") if known else state.select("id", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = as_matrix(batch.column(1), size)
            dots = as_matrix(batch.column(2), count) if known else np.zeros((len(x), count), dtype=np.int64)
            for k, at, by in moves:
                dots[:, k] += x[:, at] @ by
            cluster, distance = nearest(x, dots, squares)
            columns = [batch.column(0), batch.column(1), as_lists(dots, pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "x", "dots", "cluster", "distance"])

    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"id {kind}, x array<int>, dots array<long>, cluster int, distance long")


def moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of every cluster's vectors; a cluster without vectors stays."""
    count, size = centroids.shape
    width = size + 1  # the components and the number of vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((count, width), dtype=np.int64)
        for batch in batches:
            x, cluster = as_matrix(batch.column(0), size), batch.column(1).to_numpy()
            for k in np.unique(cluster):
                own = x[cluster == k]
                sums[k, :size] += own.sum(axis=0)
                sums[k, size] += len(own)
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(sums.ravel()[cells], pa.int64())], names=["cell", "n"])

    parts = state.select("x", "cluster").mapInArrow(run, "cell int, n long")
    total = {r.cell: int(r.n) for r in parts.groupBy("cell").agg(F.sum(F.col("n").cast(WIDE)).alias("n")).collect()}
    after = centroids.copy()
    for k in range(count):
        if members := total.get(k * width + size):
            after[k] = [total.get(k * width + j, 0) // members for j in range(size)]
    return after


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(vectors: DataFrame, how: Clustering = Clustering(), key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``key, cluster, distance`` of every vector after the last round, and the centroids."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    space = Workspace(spark, "centroids")
    table = space.keep(integer_vectors(vectors, how, key, vector), "vectors")
    centroids = start_centroids(table, how)
    if not len(centroids):
        none = table.limit(0).select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return space.result(none, "clusters").withColumnRenamed("id", key), centroids
    state = space.renew(advance(table, np.zeros_like(centroids), centroids), "state")
    space.drop("vectors")
    for _ in range(how.rounds):
        after = moved(state, centroids)
        if (after == centroids).all():
            break  # further rounds would change nothing
        state = space.renew(advance(state, centroids, after), "state")
        centroids = after
    return space.result(state.select("id", "cluster", "distance"), "clusters").withColumnRenamed("id", key), centroids


def summarise(vectors: DataFrame, how: Clustering = Clustering(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Every vector's cluster and distance, the inertia of its cluster and of all, and its centroid's digest."""
    clustered, centroids = cluster(vectors, how, key, vector)
    sums = clustered.groupBy("cluster").agg(F.sum(F.col("distance").cast(WIDE)).alias("n")).collect()  # one row a cluster
    total = sum(int(r.n) for r in sums)
    rows = [(r.cluster, int(r.n), total, centroid_digest(centroids[r.cluster])) for r in sums]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    figures = clustered.sparkSession.createDataFrame(rows, schema)
    return clustered.join(F.broadcast(figures), "cluster").select(
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
