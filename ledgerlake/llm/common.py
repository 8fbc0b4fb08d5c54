"""What several operators share: tables in the shared folder, ASCII words, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_dir

# Bytes below which an Arrow batch stays when rows go to a Python worker, so that batches
# of very long texts fit beside the heap of an executor.
BATCH_BYTES = "2m"

# Bits of a filter on hashes (2 MB), whatever the number of hashes.
FILTER_BITS = 1 << 24

# Words that a task keeps hashed; above that the memory is emptied and filled anew.
CACHED_WORDS = 120_000


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes; the row bound alone lets long texts pile up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def materialise(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder, which outlives lost executors."""
    path = scratch_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


class Workspace:
    """Intermediate tables of one operator, in a shared folder that goes once its result stands."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.count = spark, scratch_dir(spark, name), 0
        self.latest: dict[str, str] = {}

    def keep(self, frame: DataFrame, name: str, codec: str | None = None) -> DataFrame:
        """The frame as a table of the workspace, compressed by a codec other than the session's if one is named."""
        self.count += 1
        path = self.latest[name] = f"{self.folder}/{self.count:02d}-{name}"
        frame.write.parquet(path, compression=codec)
        return self.spark.read.schema(frame.schema).parquet(path)

    def renew(self, frame: DataFrame, name: str) -> DataFrame:
        """The frame as the table of that name; the one before goes once the new one stands."""
        before = self.latest.pop(name, None)
        table = self.keep(frame, name)
        if before:
            self._delete(before)
        return table

    def drop(self, name: str) -> None:
        """Delete the latest table of that name, which nothing still to be computed reads."""
        self._delete(self.latest.pop(name))

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        """Delete all tables of the workspace."""
        self._delete(self.folder)

    def result(self, frame: DataFrame, name: str) -> DataFrame:
        """The frame as a table of its own; the workspace goes."""
        done = materialise(frame, name)
        self.close()
        return done


def ascii_words(text: str | None) -> list[bytes]:
    """Maximal runs of anything but space and the control characters 9 to 13, as UTF-8.

    ``bytes.split`` parts at exactly these six characters.
    """
    return text.encode().split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``CACHED_WORDS`` of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (multiply and shift, both invertible)."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words; none where there are fewer words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    value = np.zeros(count, dtype=np.uint64)
    for offset in range(size):
        value = value * np.uint64(0x9E3779B97F4A7C15) + words[offset : offset + count]
    return mix(value)


def hash_filter(hashes: DataFrame, column: str) -> np.ndarray:
    """Bits set for the hashes of a column: a filter of fixed size with false positives only."""
    bit = F.pmod(F.col(column), F.lit(FILTER_BITS)) + 1
    parts = hashes.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    )
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in parts.collect():  # FILTER_BITS / 32,768 rows at most
        at = (row.bucket - 1) * 4096
        bits[at : at + 4096] = np.frombuffer(row.bits, dtype=np.uint8)
    return bits


def where_in_filter(frame: DataFrame, column: str, bits: np.ndarray, inside: bool = True) -> DataFrame:
    """Rows whose hash may be in the filter, so that a join need not shuffle the others.

    With ``inside`` false, the others: their hash is certainly not in it.
    """
    at = frame.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column(at).fill_null(0).to_numpy() & (FILTER_BITS - 1)
            held = (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
            kept = batch.filter(pa.array(held == inside))
            if kept.num_rows:
                yield kept

    return frame.mapInArrow(run, frame.schema)


def without_rows(documents: DataFrame, removed: DataFrame, key: str, text: str, repeated: DataFrame | None = None) -> DataFrame:
    """The documents without the rows of ``removed`` (key, text_hash), all columns kept.

    Of the rows of ``repeated`` one per key and text stays. Only rows that a filter of fixed size
    finds in either are joined; the others, mostly all, aren't shuffled.
    """
    names, spot = documents.columns, "text_hash_of_row"
    while spot in names:
        spot += "_"
    marked = documents.withColumn(spot, F.xxhash64(documents[text]))
    touched = removed.select("key", "text_hash")
    if repeated is not None:
        touched = touched.union(repeated.select("key", "text_hash"))
    bits = hash_filter(touched, "text_hash")
    clear = where_in_filter(marked, spot, bits, inside=False).drop(spot)
    close = where_in_filter(marked, spot, bits)

    def same(other: DataFrame):
        return close[spot].eqNullSafe(other["text_hash"]) & close[key].eqNullSafe(other["key"])

    kept = clear.union(close.join(touched.distinct(), same(touched), "left_anti").drop(spot))
    if repeated is not None:
        again = repeated.select("key", "text_hash").subtract(removed.select("key", "text_hash"))
        kept = kept.union(close.join(again, same(again), "left_semi").dropDuplicates([key, spot]).drop(spot))
    return kept
