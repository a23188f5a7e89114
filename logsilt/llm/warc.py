"""WARC records in seekable Zstandard bundles.

A bundle is one file: independent Zstandard frames, each with some records, then a skippable frame
with the record index, then the seek table (another skippable frame) whose footer ends the file.
Spark writes the bundles, so a lost executor leaves no half-written archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsilt.llm.common import by_batch

# The seekable format's magic numbers, and the ones of skippable frames used here.
SEEK_MAGIC = 0x8F92EAB1
SEEK_FRAME = 0x184D2A5E
INDEX_FRAME = 0x184D2A50
FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 16 * 1024 * 1024
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_RECORD = "page_id long, url string, payload binary, record_type string, refers_to long, payload_bytes long, payload_digest string"

_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ]
)


class Record(NamedTuple):
    page_id: int | None
    record_type: str
    refers_to: int | None
    payload_bytes: int
    payload_digest: str
    payload: bytes
    url: str | None


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: ten hex digits are eight digits of base 32."""
    digest = F.sha1(data)
    digits = [
        F.lpad(F.upper(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32)), 8, "0") for i in range(4)
    ]
    return F.translate(F.concat(*digits), _HEX32, _BASE32)


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _of_urn(urn: str) -> int | None:
    number = urn[len("<urn:page:") : -1]
    return int(number) if number else None


def encode_record(record: Record) -> bytes:
    revisit = record.record_type == "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {record.record_type}",
        f"WARC-Record-ID: {_urn(record.page_id)}",
        f"WARC-Payload-Digest: sha1:{record.payload_digest}",
        f"X-Payload-Length: {record.payload_bytes}",
    ]
    if record.url is not None:
        # line ends would end the header field
        head.append(f"WARC-Target-URI: {record.url.replace('%', '%25').replace(chr(13), '%0D').replace(chr(10), '%0A')}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_urn(record.refers_to)}")
    body = b"" if revisit else record.payload
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def decode_record(data: memoryview) -> Record:
    """The record that ``data`` holds; a response's payload is checked against its digest."""
    end = bytes(data).index(b"\r\n\r\n")
    lines = bytes(data[:end]).decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    payload = bytes(data[end + 4 : end + 4 + int(fields["Content-Length"])])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    url = fields.get("WARC-Target-URI")
    return Record(
        _of_urn(fields["WARC-Record-ID"]), kind,
        _of_urn(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        int(fields["X-Payload-Length"]), digest, payload,
        None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
    )


def _skippable(magic: int, data: bytes) -> bytes:
    return struct.pack("<II", magic, len(data)) + data


class BundleWriter:
    """Gathers records into frames; ``finish`` gives the bundle."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        self._frame_bytes = frame_bytes
        self._compressor = zstandard.ZstdCompressor(level=3)
        self._frames: list[bytes] = []
        self._sizes: list[tuple[int, int]] = []
        self._index: list[tuple[int | None, int, int, int]] = []
        self._open = bytearray()
        self.size = 0

    def add(self, record: Record) -> None:
        data = encode_record(record)
        self._index.append((record.page_id, len(self._frames), len(self._open), len(data)))
        self._open += data
        if len(self._open) >= self._frame_bytes:
            self._close_frame()

    def _close_frame(self) -> None:
        frame = self._compressor.compress(bytes(self._open))
        self._frames.append(frame)
        self._sizes.append((len(frame), len(self._open)))
        self.size += len(frame)
        self._open = bytearray()

    def finish(self) -> bytes:
        if self._open:
            self._close_frame()
        index = b"".join(
            struct.pack("<?qIQQ", i is not None, i or 0, frame, at, size) for i, frame, at, size in self._index
        )
        table = b"".join(struct.pack("<II", *sizes) for sizes in self._sizes)
        footer = struct.pack("<IBI", len(self._sizes), 0, SEEK_MAGIC)
        return b"".join(self._frames) + _skippable(INDEX_FRAME, index) + _skippable(SEEK_FRAME, table + footer)


class Bundle:
    """A bundle's seek table and index, and its records by position."""

    def __init__(self, data: bytes):
        self._data = memoryview(data)
        n, _, magic = struct.unpack("<IBI", self._data[-9:])
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table at the end of the bundle")
        table = len(data) - 9 - 8 * n
        sizes = list(struct.iter_unpack("<II", self._data[table : len(data) - 9]))
        self.frames, at = [], 0
        for packed, size in sizes:
            self.frames.append((at, packed, size))
            at += packed
        length = struct.unpack("<II", self._data[at : at + 8])[1]
        rows = struct.iter_unpack("<?qIQQ", self._data[at + 8 : at + 8 + length])
        #: (page_id, frame, offset in the frame, length) of every record
        self.index = [(i if known else None, frame, off, size) for known, i, frame, off, size in rows]
        self._decompressor = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> memoryview:
        at, packed, size = self.frames[number]
        return memoryview(self._decompressor.decompress(self._data[at : at + packed], max_output_size=size))

    def records(self, wanted: Iterable[tuple] | None = None) -> Iterator[Record]:
        """Records in order; with ``wanted`` (index rows) only their frames are decompressed."""
        number, data = -1, memoryview(b"")
        for _, frame, offset, length in self.index if wanted is None else sorted(wanted, key=lambda r: r[1:]):
            if frame != number:
                number, data = frame, self.frame(frame)
            yield decode_record(data[offset : offset + length])


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages as records (columns of ``_RECORD``): of equal payloads of at least ``min_bytes`` the one
    with the smallest page_id is the response, the others revisit it; shorter ones are responses.

    A null html is an empty payload. A null page_id is never the smallest; where all of a payload's
    ids are null, all are responses. Repeated rows of the smallest id are responses as well.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumns({"same": F.sha2("payload", 256), "payload_bytes": F.length("payload").cast("long")})
    # one row per shared payload; the second exchange keeps the join below free to split a hot payload
    shared = (
        keyed.where(F.col("payload_bytes") >= min_bytes).groupBy("same")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1 AND first IS NOT NULL").select(F.col("same").alias("shared"), "first")
        .repartition("first")
    )
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return keyed.join(shared, F.col("same") == F.col("shared"), "left").select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
        "payload_bytes", base32_sha1(F.col("payload")).alias("payload_digest"),
    )


def _bundles(frame_bytes: int, bundle_bytes: int):
    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(frame_bytes)
        empty = True
        for batch in batches:
            for row in batch.to_pylist():
                row["payload"] = row["payload"] or b""
                writer.add(Record(**row))
                empty = False
                if writer.size >= bundle_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([writer.finish()], pa.binary())], ["bundle"])
                    writer, empty = BundleWriter(frame_bytes), True
        if not empty:
            yield pa.RecordBatch.from_arrays([pa.array([writer.finish()], pa.binary())], ["bundle"])

    return bundles


def write_bundles(
    pages: DataFrame, path: str, min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> str:
    """Write pages (page_id, url, html) as bundle files below ``path``.

    Spark's text writer puts out bytes as they are. Each row is a file of its own, and the line end
    is the last field of the seek table's footer, so that every file is a plain seekable archive.
    """
    bundles = with_revisits(pages, min_bytes).select(
        *[f.split()[0] for f in _RECORD.split(", ")]
    ).transform(by_batch, _bundles(frame_bytes, bundle_bytes), "bundle binary")
    magic = struct.pack("<I", SEEK_MAGIC)
    (
        bundles.select(F.expr(f"CAST(substr(bundle, 1, length(bundle) - {len(magic)}) AS string)").alias("value"))
        .write.option("encoding", "ISO-8859-1").option("lineSep", magic.decode("latin-1"))
        .option("maxRecordsPerFile", 1).text(path)
    )
    return path


def _read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0").select("path", "content")


def read_bundles(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records of the bundles below ``path``; revisits have no payload of their own."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for record in Bundle(content.as_py()).records():
                    rows.append(record._asdict() | ({} if payload else {"payload": None}))
                    size += len(record.payload)
                    if size > 1 << 23 or len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return _read_files(spark, path).select("content").transform(by_batch, records, _RECORD)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Where each record is: (page_id, path, frame, frame_offset, length)."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = Bundle(content.as_py()).index
                columns = list(zip(*rows, strict=True)) or [[]] * 4
                arrays = [pa.array(columns[0], pa.int64()), pa.array([file] * len(rows), pa.string())]
                yield pa.RecordBatch.from_arrays(
                    arrays + [pa.array(c, pa.int64()) for c in columns[1:]],
                    ["page_id", "path", "frame", "frame_offset", "length"],
                )

    return _read_files(spark, path).transform(
        by_batch, index, "page_id long, path string, frame long, frame_offset long, length long"
    )


def fetch(spark: SparkSession, wanted: DataFrame) -> DataFrame:
    """The records of some index rows: only their bundles are read, only their frames unpacked."""
    places = wanted.groupBy("path").agg(
        F.collect_list(F.struct("page_id", "frame", "frame_offset", "length")).alias("places")
    )
    paths = [row.path for row in places.select("path").toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], _RECORD)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, rows in zip(batch.column("content"), batch.column("places").to_pylist(), strict=True):
                found = Bundle(content.as_py()).records([tuple(r.values()) for r in rows])
                yield pa.RecordBatch.from_pylist([r._asdict() for r in found], _ARROW)

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.join(places, "path").select("content", "places").transform(by_batch, records, _RECORD)
