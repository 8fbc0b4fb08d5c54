"""Token shards in training order: fixed-length sequences at fixed-stride places.

Tasks encode the texts of their part of the table, end each with the end mark and cut the stream into
sequences of ``length`` ids; a task pads its last one. A sequence is named by its task and its
number in it. A keyed Feistel network over the domain of these names, walked until it lands
inside, gives each sequence a place of its own; the domain is cut into ranges, one per shard,
and sequences go to the partition of their range, once. There they are sorted by place and
written one after the other, so a sequence's global slot is the number of sequences in the
shards before plus its position, and its bytes start at ``position * stride``.

So a reader may begin at any slot and reads on in sequence, and a run continues where it
stopped. One exchange moves the ids; they are never counted beforehand or sorted globally.

The table must be read from files: then a task that is run again cuts the same sequences.
Shard files have names of their own and the index lists only those of tasks that succeeded.

Defined results: a null or empty text yields no ids; repeated rows are written each; an
empty table gives an empty index and no shard; further columns are not read; texts over
``PIECE_CHARS`` are encoded in parts, cut where the pattern cuts anyway, so their ids are those of the whole text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import bounded_batches, materialise
from ledgerlake.llm.warc import shared_uri

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how this vocabulary's texts were cut before its merges were found.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256

PIECE_CHARS = 500_000
CUT = re.compile(r" (?=[^\W_])")
SEQUENCES_PER_TASK = 1 << 31
ROUNDS = 6
ID = np.dtype("<u2")


@dataclass(frozen=True)
class Layout:
    """Ids per sequence, bytes aimed at per shard, the fewest shards and the key of the order."""

    length: int = 2048
    shard_bytes: int = 64 << 20
    least_shards: int = 12
    key: str = "epoch-0"

    @property
    def stride(self) -> int:
        return self.length * ID.itemsize


@functools.lru_cache(maxsize=2)
def _encoder(vocabulary: bytes) -> tiktoken.Encoding:
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """A text in parts of some ``size`` characters, cut only before a space and a letter or number.

    The pattern cuts there in any case, so the parts have the ids of the whole; a text without such a place stays whole.
    """
    start = 0
    while len(text) - start > size and (cut := CUT.search(text, start + size)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(text: str, vocabulary: bytes) -> array:
    """The ids of a text, without the end mark."""
    encoder, ids = _encoder(vocabulary), array("H")
    for piece in pieces(text):
        ids.extend(encoder.encode_ordinary(piece))
    return ids


def decode(ids: np.ndarray, vocabulary: bytes) -> str:
    return _encoder(vocabulary).decode([int(i) for i in ids], errors="strict")


def feistel(value: int, domain: int, key: str, backward: bool = False) -> int:
    """The place of a value in a keyed permutation of ``range(domain)``, or the way back.

    The network permutes the next power of four; values that land outside walk on along
    their cycle, which comes back inside since it started there.
    """
    half = max(1, ((domain - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    order = range(ROUNDS - 1, -1, -1) if backward else range(ROUNDS)
    while True:
        left, right = value >> half, value & mask
        if backward:
            left, right = right, left
        for number in order:
            word = hashlib.blake2b(
                right.to_bytes(16, "little") + bytes([number]), key=key.encode()[:64], digest_size=8
            ).digest()
            left, right = right, left ^ (int.from_bytes(word, "little") & mask)
        if backward:
            left, right = right, left
        value = left << half | right
        if value < domain:
            return value


def pack(
    documents: DataFrame, vocabulary: bytes, layout: Layout, shards: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Sequences with their shard and place: shard, place, n_tokens, doc_ids, ids."""
    chosen = documents.select(documents[key].alias("key"), documents[text].alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    domain = max(1, chosen.rdd.getNumPartitions()) * SEQUENCES_PER_TASK
    length, secret = layout.length, layout.key

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        pending, owners, made, key_type = array("H"), [], 0, None

        def cut(ends: list[int]) -> pa.RecordBatch:
            nonlocal pending, owners, made
            places = [feistel((made + i) + task * SEQUENCES_PER_TASK, domain, secret) for i in range(len(ends))]
            data, ids, documents_of, used = memoryview(pending).cast("B"), [], [], 0
            padding = np.full(length, END, dtype=ID).tobytes()
            start, first = 0, 0
            for end in ends:
                while owners[first][1] <= start:  # its ids ended before
                    first += 1
                own = first
                names = []
                while own < len(owners) and (own == first or owners[own - 1][1] < end):
                    names.append(owners[own][0])
                    own += 1
                ids.append(bytes(data[start * 2 : end * 2]) + padding[(end - start) * 2 :])
                documents_of.append(names)
                used, start = end, end
            data.release()
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([p * shards // domain for p in places], pa.int32()),
                    pa.array([p.to_bytes(16, "big") for p in places], pa.binary()),
                    pa.array([b - a for a, b in zip([0, *ends], ends)], pa.int32()),
                    pa.array(documents_of, pa.list_(key_type)),
                    pa.array(ids, pa.binary()),
                ],
                names=["shard", "place", "n_tokens", "doc_ids", "ids"],
            )
            made += len(ends)
            pending = pending[used:]
            owners = [(k, e - used) for k, e in owners if e > used]
            return batch

        for batch in batches:
            key_type = batch.schema.field(0).type
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not value:
                    continue
                pending.extend(encode(value, vocabulary))
                pending.append(END)
                owners.append((name, len(pending)))
                if len(pending) >= length * 512:
                    yield cut(list(range(length, len(pending) + 1, length)))
        ends = list(range(length, len(pending) + 1, length))
        if len(pending) % length:
            ends.append(len(pending))
        if ends:
            yield cut(ends)

    return chosen.mapInArrow(run, f"shard int, place binary, n_tokens int, doc_ids array<{kind}>, ids binary")


def write_shards(
    documents: DataFrame,
    vocabulary_path: str = VOCABULARY,
    layout: Layout = Layout(),
    folder: str | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write the shards; the index: path, shard, position, n_tokens, crc32, doc_ids.

    The vocabulary is read by the driver and travels with the tasks (under 1 MB).
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    vocabulary = Path(vocabulary_path).read_bytes()
    size = documents.agg(F.sum(F.octet_length(documents[text]).cast("long")).alias("n")).first().n or 0
    # an id stands for two and a half bytes of text or so: as many bytes of ids
    shards = max(layout.least_shards, -(-size // layout.shard_bytes))
    target, stride = folder or shared_uri(spark, "shards"), layout.stride
    packed = pack(documents, vocabulary, layout, shards, key, text)
    ranges = packed.repartitionById(shards, "shard").sortWithinPartitions("shard", "place")
    key_type = packed.schema["doc_ids"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(target)
        system.create_dir(base, recursive=True)
        sink, at, path, position = None, None, "", 0
        for batch in batches:
            paths, positions, sums = [], [], []
            for shard, ids in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist()):
                if shard != at:
                    if sink is not None:
                        sink.close()
                    name = f"shard-{shard:08d}-{uuid.uuid4().hex[:12]}.bin"
                    sink = system.open_output_stream(f"{base}/{name}", compression=None)
                    at, path, position = shard, f"{target.rstrip('/')}/{name}", 0
                assert len(ids) == stride
                sink.write(ids)
                paths.append(path)
                positions.append(position)
                sums.append(zlib.crc32(ids))
                position += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(paths, pa.string()),
                    batch.column(0),
                    pa.array(positions, pa.int64()),
                    batch.column(2),
                    pa.array(sums, pa.int64()),
                    batch.column(3),
                ],
                names=["path", "shard", "position", "n_tokens", "crc32", "doc_ids"],
            )
        if sink is not None:
            sink.close()

    index = ranges.mapInArrow(
        run, f"path string, shard int, position long, n_tokens int, crc32 long, doc_ids {key_type}"
    )
    return materialise(index, "shard-index")


def shard_table(index: DataFrame) -> DataFrame:
    """One row per shard file: path, shard, n_sequences and the slot of its first sequence."""
    files = index.groupBy("path", "shard").agg(F.count("*").alias("n_sequences"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return files.withColumn("first_slot", F.coalesce(F.sum("n_sequences").over(before), F.lit(0)))


def with_slots(index: DataFrame) -> DataFrame:
    """The index with the global slot of every sequence."""
    files = shard_table(index).select("path", "first_slot")
    return index.join(files, "path").withColumn("slot", F.col("first_slot") + F.col("position")).drop("first_slot")


def read_shards(files: DataFrame, layout: Layout = Layout(), start: int = 0, stop: int | None = None) -> DataFrame:
    """Sequences of the slots from ``start`` up to ``stop``: slot, crc32, ids (unsigned 16-bit, little-endian).

    ``files`` has path, n_sequences and first_slot. Each file is read in sequence from the
    first wanted place on; files without a wanted slot aren't opened.
    """
    wanted = files.where(F.col("first_slot") + F.col("n_sequences") > start)
    if stop is not None:
        wanted = wanted.where(F.col("first_slot") < stop)
    stride, block = layout.stride, 256
    chosen = wanted.select("path", "n_sequences", "first_slot")
    chosen = chosen.repartition(max(1, files.sparkSession.sparkContext.defaultParallelism), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, count, first in zip(*(c.to_pylist() for c in batch.columns)):
                low = max(0, start - first)
                high = count if stop is None else min(count, stop - first)
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_file(name) as source:
                    source.seek(low * stride)
                    for at in range(low, high, block):
                        data = source.read(min(block, high - at) * stride)
                        parts = [data[i : i + stride] for i in range(0, len(data), stride)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(range(first + at, first + at + len(parts)), pa.int64()),
                                pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                                pa.array(parts, pa.binary()),
                            ],
                            names=["slot", "crc32", "ids"],
                        )

    return chosen.mapInArrow(run, "slot long, crc32 long, ids binary")
