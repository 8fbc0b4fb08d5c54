"""Web archives: one gzip member per record, written by tasks and read back in sequence.

Writing: a payload's SHA-1 is taken by Spark; payloads that occur more than once are found by
one aggregation over digests, joined back to the rows (a plain equi-join, which Spark splits
where one payload is very frequent). Each task streams its rows to archives of bounded size
in the shared folder under names of its own; the table of archives written at the end lists
only those of tasks that succeeded, so lost or repeated attempts leave nothing in it.

Reading: a task opens one archive and inflates it in blocks of fixed size. A record is framed
by its ``Content-Length``, its block and payload digests are verified, and a member must end
where its record ends. Memory holds one record and one block, never an archive.

Defined results: a null payload is an empty one; a null url has no target header. Of rows with equal
payloads of at least ``least_revisit`` bytes, every row with the largest id is a response
(so repeated rows are both responses) and the others, null ids included, revisit it. Without
any id among them all are responses. An empty table gives no archive and no rows; further
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import bounded_batches, materialise
from ledgerlake.session import scratch_dir

ARCHIVE_BYTES = 256 << 20
BLOCK_BYTES = 1 << 16
DATE = "2024-01-01T00:00:00Z"

RECORDS = (
    "id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary, archive string, offset long"
)


class DamagedArchive(ValueError):
    """A record that breaks the format or does not match its digest."""


def _digest(data: bytes) -> str:
    """SHA-1 in Base32, as archives state it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(
    page: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None
) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP head alone."""
    stated = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    name = f"urn:page:{page}" if page is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Block-Digest: {_digest(block)}",
        f"WARC-Payload-Digest: {stated}",
    ]
    if url is not None:  # line ends in an address would end the header
        target = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
        lines.append(f"WARC-Target-URI: {target}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    data = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Inflated:
    """The bytes of one gzip member after the other, inflated block by block."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.raw, self.offset = stream, b"", 0

    def next_member(self) -> bool:
        if not self.raw:
            self.raw = self.stream.read(BLOCK_BYTES)
        self.unpacker, self.data = zlib.decompressobj(31), bytearray()
        return bool(self.raw)

    def _more(self) -> bool:
        """Inflate some more of this member; false at its end."""
        if self.unpacker.eof:
            return False
        self.raw = self.raw or self.stream.read(BLOCK_BYTES)
        if not self.raw:
            raise DamagedArchive("the archive ends inside a record")
        before = len(self.raw)
        try:
            self.data += self.unpacker.decompress(self.raw, BLOCK_BYTES)
        except zlib.error as error:
            raise DamagedArchive(f"not a gzip member: {error}") from error
        self.raw = self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail
        self.offset += before - len(self.raw)
        return True

    def until(self, mark: bytes) -> bytes:
        start = 0
        while (at := self.data.find(mark, start)) < 0:
            start = max(0, len(self.data) - len(mark) + 1)
            if not self._more():
                raise DamagedArchive("a header does not end")
        return self._take(at + len(mark))

    def exactly(self, count: int) -> bytes:
        while len(self.data) < count:
            if not self._more():
                raise DamagedArchive("a record is shorter than it states")
        return self._take(count)

    def _take(self, count: int) -> bytes:
        taken = bytes(self.data[:count])
        del self.data[:count]
        return taken

    def end(self) -> None:
        while self._more():
            pass
        if self.data:
            raise DamagedArchive("a member is longer than its record")


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:] if line)}


def _page(name: str | None) -> int | None:
    value = (name or "").strip("<>")
    return int(value.removeprefix("urn:page:")) if value.startswith("urn:page:") else None


def read_records(stream: BinaryIO) -> Iterator[tuple]:
    """The records of one archive in order: the fields of ``RECORDS`` but for the archive."""
    member = _Inflated(stream)
    while True:
        offset = member.offset
        if not member.next_member():
            return
        head = member.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/1."):
            raise DamagedArchive("a member does not start with a record")
        fields = _fields(head)
        block = member.exactly(int(fields["content-length"]))
        if member.exactly(4) != b"\r\n\r\n":
            raise DamagedArchive("a record does not end after its block")
        member.end()
        if _digest(block) != fields["warc-block-digest"]:
            raise DamagedArchive("a block does not match its digest")
        http, _, payload = block.partition(b"\r\n\r\n")
        stated = fields["warc-payload-digest"]
        if fields["warc-type"] == "response" and _digest(payload) != stated:
            raise DamagedArchive("a payload does not match its digest")
        url = fields.get("warc-target-uri")
        yield (
            _page(fields["warc-record-id"]),
            None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
            fields["warc-type"],
            _page(fields.get("warc-refers-to")),
            int(_fields(http)["content-length"]),
            base64.b32decode(stated.removeprefix("sha1:")).hex(),
            payload if fields["warc-type"] == "response" else None,
            offset,
        )


def plan_records(
    pages: DataFrame, least_revisit: int, key: str = "page_id", url: str = "url", payload: str = "html"
) -> DataFrame:
    """Rows as records: id, url, payload, digest, record type and the response of a revisit."""
    rows = pages.select(
        pages[key].cast("long").alias("id"),
        pages[url].alias("url"),
        F.coalesce(pages[payload], F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    repeated = (
        rows.where(F.octet_length("payload") >= least_revisit)
        .groupBy("digest")
        .agg(F.max("id").alias("response"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("response").isNotNull())
        .select("digest", "response")
    )
    repeated = materialise(repeated, "repeated-payloads")
    joined = rows.join(repeated, "digest", "left")
    revisits = F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))
    return joined.select(
        "id",
        "url",
        "payload",
        "digest",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("response")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write records to archives in a shared folder; the table of archives written.

    An archive is closed once it holds ``archive_bytes``.
    """
    bounded_batches(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        sink, path, written, count = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if sink is None:
                    path, written, count = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = system.open_output_stream(path, compression=None)
                data = record_bytes(
                    row["id"], row["url"], row["payload"], row["digest"], row["record_type"], row["refers_to"]
                )
                sink.write(data)
                written, count = written + len(data), count + 1
                if written >= archive_bytes:
                    sink.close()
                    done.append((path, count, written))
                    sink = None
        if sink is not None:
            sink.close()
            done.append((path, count, written))
        name = [folder.rstrip("/") + "/" + p.rpartition("/")[2] for p, _, _ in done]
        yield pa.RecordBatch.from_arrays(
            [pa.array(name, pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
            names=["archive", "n_records", "n_bytes"],
        )

    return materialise(records.mapInArrow(run, "archive string, n_records long, n_bytes long"), "archives")


def read_archives(archives: DataFrame, payloads: bool = True, batch_bytes: int = 4 << 20) -> DataFrame:
    """Every record of the archives listed in column ``archive``: one task step per archive."""
    names = archives.select("archive")
    names = names.repartition(max(1, names.sparkSession.sparkContext.defaultParallelism), "archive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
             ("archive", pa.string()), ("offset", pa.int64())]
        )
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                system, path = fs.FileSystem.from_uri(archive)
                held, size = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for *fields, payload, offset in read_records(stream):
                        held.append((*fields, payload if payloads else None, archive, offset))
                        size += 200 + len(payload or b"")
                        if size >= batch_bytes:
                            yield _batch(held, schema)
                            held, size = [], 0
                yield _batch(held, schema)

    return names.mapInArrow(run, RECORDS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def shared_uri(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place, with its scheme."""
    folder = scratch_dir(spark, name)
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
