"""Vector code compression: every part of a vector becomes the number of its nearest codebook entry.

Vectors are integers, cut into equal parts; each part position has a codebook of its own. The nearest entry is found
in the integer Walsh-Hadamard transform of the parts and entries, padded with zeros to a power of two ``n``:
``|Hx - Hc|^2 = n |x - c|^2``, so the transformed squared differences are exact multiples of the true ones. They are added in
sequency order (rows of the transform by their number of sign changes), a block of coefficients at a time. An
entry whose sum so far exceeds the whole distance of a known entry is out; what is left after the last block is compared in full,
the lower index first at ties. All of it is whole numbers.

A round is one pass over the vectors: tasks assign their parts and add up, per entry, the components and the number of parts; what
comes to the driver are at most ``parts * entries * (length + 1)`` sums, whatever the number of vectors. Only the codebooks pass from
round to round, so nothing is lost with an executor. Errors per label are summed by partial aggregation and joined back; a label with
most of the vectors is one row there.

Defined results: vectors that are null or hold a null or non-finite component are left out; the length of all is that of
the longest, rounded up to whole parts, and shorter vectors (empty ones too) are extended with zeros; equal start ids are ordered by
their components, null ids come last; repeated rows are vectors of their own; with fewer vectors than entries the codebooks are
shorter; an empty table gives an empty one; null labels count as one label; components whose distances would leave 64 bits stop the run;
further columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import Workspace, bounded_batches
from ledgerlake.llm.vectors import as_lists, as_matrix, finite_vectors, floored

WIDE = "decimal(38,0)"
# Vectors that are compared with all entries at once (the first block of coefficients only).
TILE = 1024


@dataclass(frozen=True)
class Coding:
    """Scale of components, parts of a vector, entries of a codebook, rounds, and coefficients per block."""

    scale: int = 1024
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    block: int = 4


def padded(length: int) -> int:
    """The least power of two that is not below ``length``."""
    return 1 << max(0, length - 1).bit_length()


def sequency_order(n: int) -> np.ndarray:
    """Rows of the natural Walsh-Hadamard matrix by their number of sign changes."""
    signs = np.ones((1, 1), dtype=np.int64)
    while len(signs) < n:
        signs = np.block([[signs, signs], [signs, -signs]])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def transformed(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row, zero-padded, coefficients in sequency order."""
    n = padded(rows.shape[1])
    out = np.zeros((len(rows), n), dtype=np.int64)
    out[:, : rows.shape[1]] = rows
    half = 1
    while half < n:
        pairs = out.reshape(len(rows), n // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), n)
        half *= 2
    return out[:, sequency_order(n)]


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    difference = a - b
    return np.einsum("ij,ij->i", difference, difference)


def nearest_entries(parts: np.ndarray, entries: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of every part, the lower one at ties, and the squared distance.

    Both are transformed rows of ``n`` coefficients.
    """
    n = parts.shape[1]
    index, distance = np.empty(len(parts), dtype=np.int64), np.empty(len(parts), dtype=np.int64)
    for low in range(0, len(parts), TILE):
        tile = parts[low : low + TILE]
        sums = np.zeros((len(tile), len(entries)), dtype=np.int64)
        for j in range(min(block, n)):
            sums += np.square(tile[:, j, None] - entries[None, :, j])
        bound = _squares(tile, entries[sums.argmin(axis=1)])
        row, entry = np.nonzero(sums <= bound[:, None])  # by row, then by entry
        sums = sums[row, entry]
        for at in range(block, n, block):
            sums = sums + _squares(tile[row, at : at + block], entries[entry, at : at + block])
            starts = np.searchsorted(row, np.arange(len(tile)))
            least = np.minimum.reduceat(sums, starts)  # every row keeps an entry: that of its bound
            best = np.flatnonzero(sums == least[row])
            best = best[np.searchsorted(row[best], np.arange(len(tile)))]
            bound = np.minimum(bound, _squares(tile, entries[entry[best]]))
            held = sums <= bound[row]
            row, entry, sums = row[held], entry[held], sums[held]
        best = np.flatnonzero(sums == bound[row])
        best = best[np.searchsorted(row[best], np.arange(len(tile)))]
        index[low : low + TILE], distance[low : low + TILE] = entry[best], sums[best] // n
    return index, distance


def common_length(vectors: DataFrame, how: Coding, vector: str) -> int:
    """Components of the longest vector, rounded up to whole parts."""
    longest = vectors.agg(F.max(F.size(F.col(vector))).alias("n")).first().n or 0
    return max(1, -(-max(0, longest) // how.parts)) * how.parts


def integer_vectors(vectors: DataFrame, how: Coding, length: int, key: str, vector: str, label: str) -> DataFrame:
    """``id, label, x`` of the vectors that take part."""
    chosen = vectors.select(vectors[key].alias("id"), vectors[label].alias("label"), vectors[vector].alias("v"))
    most = (1 << 30) // padded(length // how.parts)  # 4 n^2 most^2 stays below 2^62, four such sums below 2^64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, lengths, values = finite_vectors(batch.column(2))
            x = np.zeros((len(row), length), dtype=np.int64)
            x[np.arange(length) < lengths[:, None]] = floored(values, how.scale, most)
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), as_lists(x, pa.int32())], names=["id", "label", "x"]
            )

    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema}
    return chosen.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, x array<int>")


def start_codebooks(table: DataFrame, how: Coding, length: int) -> np.ndarray:
    """parts x entries x components, from the vectors of the smallest ids."""
    first = table.select("id", "x").orderBy(F.asc_nulls_last("id"), "x").limit(how.entries).collect()  # one per entry
    rows = np.array([row.x for row in first], dtype=np.int64).reshape(len(first), how.parts, length // how.parts)
    return rows.transpose(1, 0, 2)


def _assigned(x: np.ndarray, books: np.ndarray, books_transformed: list[np.ndarray], block: int) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every part: rows x parts."""
    parts, _, width = books.shape
    found = [
        nearest_entries(transformed(x[:, p * width : (p + 1) * width]), books_transformed[p], block) for p in range(parts)
    ]
    return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def moved(table: DataFrame, books: np.ndarray, how: Coding) -> np.ndarray:
    """The codebooks after a round; an entry that no part is nearest to stays."""
    parts, count, width = books.shape
    ready = [transformed(book) for book in books]
    wide = width + 1  # the components and the number of parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * count, wide), dtype=np.int64)
        for batch in batches:
            x = as_matrix(batch.column(0), parts * width)
            entry, _ = _assigned(x, books, ready, how.block)
            for p in range(parts):
                at = p * count + entry[:, p]
                np.add.at(sums[:, :width], at, x[:, p * width : (p + 1) * width])
                sums[:, width] += np.bincount(at, minlength=parts * count)
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(sums.ravel()[cells], pa.int64())], names=["cell", "n"])

    found = table.select("x").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum(F.col("n").cast(WIDE)).alias("n"))
    total = {r.cell: int(r.n) for r in found.collect()}
    after = books.reshape(parts * count, width).copy()
    for cell in range(parts * count):
        if members := total.get(cell * wide + width):
            after[cell] = [total.get(cell * wide + j, 0) // members for j in range(width)]
    return after.reshape(books.shape)


def coded(table: DataFrame, books: np.ndarray, how: Coding) -> DataFrame:
    """``id, label, code, error``: two hexadecimal digits a part (as many as entries need), and the squared distances summed."""
    parts, count, width = books.shape
    ready = [transformed(book) for book in books]
    digits = max(2, len(f"{how.entries - 1:x}"))
    names = pa.array([f"{e:0{digits}x}" for e in range(count)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, distance = _assigned(as_matrix(batch.column(2), parts * width), books, ready, how.block)
            texts = [names.take(pa.array(entry[:, p])) for p in range(parts)]
            code = pc.binary_join_element_wise(*texts, "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), code, pa.array(distance.sum(axis=1), pa.int64())], names=["id", "label", "code", "error"]
            )

    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    return table.select("id", "label", "x").mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, how: Coding = Coding(), key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, np.ndarray]:
    """``id, label, code, error`` of every vector, and the codebooks (parts x entries x components)."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    space = Workspace(spark, "codes")
    length = common_length(vectors, how, vector)
    table = space.keep(integer_vectors(vectors, how, length, key, vector, label), "vectors")
    books = start_codebooks(table, how, length)
    if not books.size:
        none = table.limit(0).select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return space.result(none, "codes"), books
    for _ in range(how.rounds):
        after = moved(table, books, how)
        if (after == books).all():
            break  # further rounds would change nothing
        books = after
    return space.result(coded(table, books, how), "codes"), books


def restored(codes: DataFrame, books: np.ndarray, code: str = "code") -> DataFrame:
    """The codes with ``x``: the integer vector that each stands for."""
    parts, count, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(code)).to_pylist()
            digits = len(texts[0]) // parts if texts else 2
            entry = np.array([[int(t[p * digits : (p + 1) * digits], 16) for p in range(parts)] for t in texts], dtype=np.int64)
            x = books[np.arange(parts), entry.reshape(-1, parts)].reshape(-1, parts * width)
            yield pa.RecordBatch.from_arrays([*batch.columns, as_lists(x, pa.int32())], names=[*batch.schema.names, "x"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in codes.schema)
    return codes.mapInArrow(run, f"{fields}, x array<int>")


def summarise(vectors: DataFrame, how: Coding = Coding(), key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Every vector's code and error, the error of its label, and the digest of all codebooks."""
    codes, books = compress(vectors, how, key, vector, label)
    sums = codes.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    return codes.join(sums, codes["label"].eqNullSafe(sums["same"])).select(
        F.col("id").alias(key), "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
