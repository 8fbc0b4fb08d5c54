"""Benchmark decontamination by greedy string tiling.

Texts become words of letters and digits, lower-cased, so that marks and line ends don't part
a passage. A test item and a document are compared when enough of the item's runs of
``least`` words, the seeds, occur in the document:

1. The seeds of all items go into a bitmap of fixed size (``BITMAP`` bits, whatever the
   number of items), and one scan of the documents gives their runs that may be seeds.
2. An equi-join with the item seeds gives pairs. The words of an item that lie in shared
   seeds bound what tiles can cover; pairs whose bound misses the threshold end here.
3. The pairs left get their texts and are tiled: longest common runs are searched by running
   Karp-Rabin hashes at shrinking lengths, marked from the longest to the shortest, and never
   overlap, so passages count in any order. An item whose words are covered up to the
   threshold contaminates the document.

A very frequent passage makes a long list for its seeds on the side of the documents only; the
equi-joins are such that Spark splits them.

Defined results: null or empty documents and items have no words and no seeds; items with fewer
than ``least`` words can't be tiled and contaminate nothing; repeated document or item rows get
equal results; without items or documents nothing is contaminated; ids may be null or
repeated, as a document is known by its id and its text; further columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import (
    WordHashes,
    bounded_batches,
    hash_filter,
    materialise,
    mix,
    where_in_filter,
    without_rows,
)

BITMAP = 1 << 22

_LOWER = bytes.maketrans(
    bytes(c for c in range(128) if not chr(c).isalnum()) + bytes(range(65, 91)),
    b" " * sum(not chr(c).isalnum() for c in range(128)) + bytes(range(97, 123)),
)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass(frozen=True)
class Tiling:
    """Fewest words of a tile, length searched first and percentage of an item to be covered."""

    least: int = 5
    first: int = 20
    percent: int = 60


def plain_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and code points above ASCII; A-Z lower-cased."""
    return text.encode().translate(_LOWER).split() if text else []


def _powers(base: int, count: int) -> np.ndarray:
    values = np.full(count, base, dtype=np.uint64)
    if count:
        values[0] = 1
    return np.multiply.accumulate(values)


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``length`` words, each from sums that run along."""
    count = len(words) - length + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * _powers(_BASE, len(words)), dtype=np.uint64)])
    return mix((sums[length:] - sums[:-length]) * _powers(_INVERSE, count))


def _free_runs(marked: np.ndarray, length: int) -> np.ndarray:
    """Whether each run of ``length`` words is without a mark."""
    sums = np.concatenate([[0], np.cumsum(marked)])
    return sums[length:] == sums[:-length]


def tiles(item: np.ndarray, document: np.ndarray, tiling: Tiling) -> list[tuple[int, int, int]]:
    """Greedy tiling of two sequences of word codes: (item start, document start, length)."""
    found: list[tuple[int, int, int]] = []
    item_marked = np.zeros(len(item), dtype=bool)
    document_marked = np.zeros(len(document), dtype=bool)
    length = max(tiling.least, min(tiling.first, len(item)))
    a, b = item.tolist(), document.tolist()
    while length >= tiling.least:
        own = run_hashes(item, length)
        own_free = _free_runs(item_marked, length) if len(own) else np.empty(0, dtype=bool)
        places: dict[int, list[int]] = {}
        for t in np.flatnonzero(own_free).tolist():
            places.setdefault(int(own[t]), []).append(t)
        theirs = run_hashes(document, length)
        hits = np.flatnonzero(np.isin(theirs, own[own_free]) & _free_runs(document_marked, length)) if places and len(theirs) else []
        matches, longest = [], 0
        for p in np.asarray(hits, dtype=np.int64).tolist():
            for t in places[int(theirs[p])]:
                if p and t and a[t - 1] == b[p - 1] and not item_marked[t - 1] and not document_marked[p - 1]:
                    continue  # part of the match that starts one word before
                k = 0
                while (
                    t + k < len(a) and p + k < len(b) and a[t + k] == b[p + k]
                    and not item_marked[t + k] and not document_marked[p + k]
                ):
                    k += 1
                if k >= length:
                    matches.append((k, t, p))
                    longest = max(longest, k)
        if longest > 2 * length:  # start over with the long ones
            length = longest
            continue
        queue = [(-k, p, t) for k, t, p in matches]
        heapq.heapify(queue)
        while queue:
            k, p, t = heapq.heappop(queue)
            k = -k
            free = ~(item_marked[t : t + k] | document_marked[p : p + k])
            if free.all():
                item_marked[t : t + k] = True
                document_marked[p : p + k] = True
                found.append((t, p, k))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]]))).tolist()
            for low, high in zip(edges[::2], edges[1::2]):  # what marks left of it
                if high - low >= length:
                    heapq.heappush(queue, (low - high, p + low, t + low))
        if length == tiling.least:
            break
        length = max(tiling.least, length // 2)
    return found


def _seed_rows(texts: DataFrame, least: int, bitmap: np.ndarray | None) -> DataFrame:
    """Distinct seeds per row of (key, text_hash, text), with places if there's no bitmap."""
    kind = texts.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        bits = None if bitmap is None else np.unpackbits(bitmap, bitorder="little")
        for batch in batches:
            rows, seeds, places, lengths = [], [], [], []
            for number, text in enumerate(batch.column(2).to_pylist()):
                words = plain_words(text)
                runs = run_hashes(hashes.of(words), least)
                if bits is not None:
                    runs = np.unique(runs[bits[(runs & np.uint64(BITMAP - 1)).astype(np.int64)] == 1])
                rows.append(np.full(len(runs), number, dtype=np.int64))
                seeds.append(runs.view(np.int64))
                places.append(np.arange(len(runs), dtype=np.int64))
                lengths.append(np.full(len(runs), len(words), dtype=np.int64))
            at = pa.array(np.concatenate(rows) if rows else [], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at)]
                + [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (seeds, places, lengths)],
                names=["key", "text_hash", "seed", "place", "n_words"],
            )

    return texts.mapInArrow(run, f"key {kind}, text_hash long, seed long, place long, n_words long")


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """Bits of the seeds: at most ``BITMAP`` of them, whatever the number of items."""
    bit = F.col("seed").bitwiseAND(F.lit(BITMAP - 1))
    used = seeds.select(bit.alias("bit")).distinct().toArrow()["bit"].to_numpy()
    bits = np.zeros(BITMAP, dtype=np.uint8)
    bits[used] = 1
    return np.packbits(bits, bitorder="little")


def _same(left: str, right: str) -> Column:
    return F.col(f"{left}text_hash").eqNullSafe(F.col(f"{right}text_hash")) & F.col(f"{left}key").eqNullSafe(F.col(f"{right}key"))


def _keyed(frame: DataFrame, key: str, text: str) -> DataFrame:
    body = frame[text]
    return frame.select(frame[key].alias("key"), F.xxhash64(body).alias("text_hash"), body.alias("text"))


def contaminations(
    documents: DataFrame,
    items: DataFrame,
    tiling: Tiling = Tiling(),
    key: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """Pairs of a document and an item that its tiles cover: key, text_hash, item, covered, n_words, n_tiles."""
    bounded_batches(documents.sparkSession)
    texts = _keyed(documents, key, text)
    tests = _keyed(items, item, text).distinct()
    seeds = materialise(_seed_rows(tests, tiling.least, None), "item-seeds")
    seeds = seeds.select(F.col("key").alias("item"), F.col("text_hash").alias("item_hash"), "seed", "place", "n_words")
    hits = _seed_rows(texts, tiling.least, _bitmap(seeds)).select("key", "text_hash", "seed").distinct()
    shared = hits.join(seeds, "seed").select("key", "text_hash", "item", "item_hash", "place", "n_words")
    pair = Window.partitionBy("key", "text_hash", "item", "item_hash")  # at most the places of one item
    reach = F.least(F.lead("place").over(pair.orderBy("place")) - F.col("place"), F.lit(tiling.least))
    bound = (
        shared.withColumn("reach", F.coalesce(reach, F.lit(tiling.least)))
        .groupBy("key", "text_hash", "item", "item_hash", "n_words")
        .agg(F.sum("reach").alias("most"))
        .where(100 * F.col("most") >= tiling.percent * F.col("n_words"))
        .select("key", "text_hash", "item", "item_hash")
    )
    bound = materialise(bound, "tiling-pairs")
    test_texts = tests.select(F.col("key").alias("i_key"), F.col("text_hash").alias("i_text_hash"), F.col("text").alias("item_text"))
    pairs = bound.select(F.col("item").alias("p_key"), F.col("item_hash").alias("p_text_hash"), F.col("key").alias("d_key"), F.col("text_hash").alias("d_text_hash"))
    pairs = pairs.join(test_texts, _same("p_", "i_")).select("d_key", "d_text_hash", F.col("p_key").alias("item"), "item_text")
    pairs = materialise(pairs, "tiling-texts")
    near = where_in_filter(texts, "text_hash", hash_filter(pairs, "d_text_hash"))
    both = near.join(pairs, _same("", "d_")).select("key", "text_hash", "item", "text", "item_text")
    key_kind, item_kind = both.schema["key"].dataType.simpleString(), both.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered, lengths, numbers = [], [], []
            for one, other in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                codes: dict[bytes, int] = {}
                words, test = plain_words(one), plain_words(other)
                coded = [
                    np.fromiter((codes.setdefault(w, len(codes) + 1) for w in side), dtype=np.uint64, count=len(side))
                    for side in (test, words)
                ]
                found = tiles(coded[0], coded[1], tiling)
                covered.append(sum(k for _, _, k in found))
                lengths.append(len(test))
                numbers.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2)] + [pa.array(x, pa.int64()) for x in (covered, lengths, numbers)],
                names=["key", "text_hash", "item", "covered", "n_words", "n_tiles"],
            )

    tiled = both.mapInArrow(
        run, f"key {key_kind}, text_hash long, item {item_kind}, covered long, n_words long, n_tiles long"
    )
    return tiled.where(100 * F.col("covered") >= tiling.percent * F.col("n_words")).distinct()


def judge(documents: DataFrame, items: DataFrame, tiling: Tiling = Tiling(), key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """Per document: the key, contaminated, the items found (sorted) and the largest percentage covered."""
    found = materialise(contaminations(documents, items, tiling, key, item, text), "contaminations")
    per_document = found.groupBy("key", "text_hash").agg(
        F.sort_array(F.collect_set("item")).alias("items"),  # at most the items
        F.max(100.0 * F.col("covered") / F.col("n_words")).alias("covered_pct"),
    )
    per_document = per_document.select(F.col("key").alias("f_key"), F.col("text_hash").alias("f_text_hash"), "items", "covered_pct")
    rows = _keyed(documents, key, text).drop("text")
    joined = rows.join(per_document, _same("", "f_"), "left")
    return joined.select(
        F.col("key").alias(key),
        F.col("f_text_hash").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast(per_document.schema["items"].dataType)).alias("items"),
        F.coalesce("covered_pct", F.lit(0.0)).alias("covered_pct"),
    )


def remove_contaminated(documents: DataFrame, items: DataFrame, tiling: Tiling = Tiling(), key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """The documents that no item contaminates, with all their columns."""
    found = materialise(contaminations(documents, items, tiling, key, item, text), "contaminations")
    return without_rows(documents, found.select("key", "text_hash").distinct(), key, text)
