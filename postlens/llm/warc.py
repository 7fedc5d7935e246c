"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: each task attempt writes archives of bounded size, under names of its own, into a folder
all executors share, and returns their names as rows. Spark keeps the rows of one attempt per
task, so archives of lost or repeated attempts are not on the list and are not read.
Reading: Spark hands each archive to a task as bytes; the task loads the dictionary, walks from
frame to frame by the lengths of their blocks, decodes one record per frame, and checks headers,
lengths and digests.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
import zstandard
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.session import fresh_folder

# Fixed values of the formats.
VERSION = b"WARC/1.1"
ZSTD_FRAME = 0xFD2FB528
SKIPPABLE = 0x184D2A50
DICTIONARY = 0x184D2A5D
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Payloads of at least so many bytes are stored once.
MIN_REVISIT = 100
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 32 << 10
# The first records of an archive train its dictionary: at most so many, of so many bytes in all.
SAMPLES, SAMPLE_BYTES = 400, 2 << 20
DATE = "1970-01-01T00:00:00Z"

RECORD = (
    "archive string, frame long, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary, error string"
)
_ESCAPE = re.compile(r"[\x00-\x20\x7f]")
_URN = re.compile(r"<urn:x-page:(-?\d+|none)>")


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page_of(urn: str | None) -> int | None:
    found = _URN.fullmatch(urn or "")
    if not found:
        raise ValueError(f"no page in {urn!r}")
    return None if found[1] == "none" else int(found[1])


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit holds the HTTP header of the full payload, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _urn(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": url and _ESCAPE.sub(lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Profile": REVISIT if revisit else None,
        "WARC-Refers-To": _urn(first) if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value)
    return VERSION + b"\r\n" + head.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def archive_frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """A dictionary frame, unless there is too little to train on, and a frame per record."""
    sample, size = [], 0
    for r in islice(records, SAMPLES):
        sample.append(r)
        size += len(r)
        if size >= SAMPLE_BYTES:
            break
    trained = None
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, [r[:16_384] for r in sample], k=256, d=8)
    except zstandard.ZstdError:
        pass  # too few or too uniform records; frames then stand alone
    if trained:
        yield struct.pack("<II", DICTIONARY, len(trained)) + trained.as_bytes()
    codec = zstandard.ZstdCompressor(dict_data=trained, write_checksum=True)
    for r in chain(sample, records):
        yield codec.compress(r)


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, by the lengths it states."""
    (magic,) = struct.unpack_from("<I", data, at)
    if magic & 0xFFFFFFF0 == SKIPPABLE:
        end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
    elif magic == ZSTD_FRAME:
        flags = data[at + 4]
        single = flags >> 5 & 1
        content = (single, 2, 4, 8)[flags >> 6]
        end = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + content
        last = 0
        while not last:
            header = int.from_bytes(data[end : end + 3], "little")
            if end + 3 > len(data):
                raise ValueError("frame is cut off")
            last, kind, size = header & 1, header >> 1 & 3, header >> 3
            end += 3 + (1 if kind == 1 else size)
        end += 4 * (flags >> 2 & 1)
    else:
        raise ValueError(f"no frame at byte {at}")
    if end > len(data):
        raise ValueError("frame is cut off")
    return end


def parse(data: bytes) -> tuple[int | None, str | None, str, int | None, int, str, bytes | None]:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload`` of a record."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if first != VERSION or not mark:
        raise ValueError("no WARC header")
    fields = {}
    for line in lines:
        name, colon, value = line.decode().partition(":")
        if not colon:
            raise ValueError(f"no field: {line!r}")
        fields[name.strip().lower()] = value.strip()
    if missing := {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys():
        raise ValueError(f"fields are missing: {sorted(missing)}")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes, its header says {size}")
    http, mark, payload = rest[:size].partition(b"\r\n\r\n")
    length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
    digest = re.fullmatch(r"sha256:([0-9a-f]{64})", fields.get("warc-payload-digest", ""))
    if not (mark and length and digest):
        raise ValueError("no HTTP header, payload length or payload digest")
    kind, stated = fields["warc-type"], int(length[1])
    if kind == "response":
        if len(payload) != stated or hashlib.sha256(payload).hexdigest() != digest[1]:
            raise ValueError("the payload does not have the stated length and digest")
        refers = None
    elif kind == "revisit":
        refers = _page_of(fields.get("warc-refers-to"))
        payload = None
    else:
        raise ValueError(f"unknown record type {kind!r}")
    return _page_of(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, refers, stated, digest[1], payload


def records(content: bytes) -> Iterator[tuple[int, tuple | None, str | None]]:
    """``(frame, record, error)`` of each record frame; a broken frame ends the archive."""
    data, at, number = memoryview(content), 0, 0
    known = None
    while at < len(data):
        try:
            end = frame_end(data, at)
        except (ValueError, struct.error, IndexError) as error:
            yield number, None, str(error)
            return
        (magic,) = struct.unpack_from("<I", data, at)
        if magic == DICTIONARY and at == 0:
            raw = bytes(data[8:end])
            if raw[:4] == struct.pack("<I", ZSTD_FRAME):
                raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
            known = zstandard.ZstdCompressionDict(raw)
        elif magic == ZSTD_FRAME:
            try:
                decoder = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
                yield number, parse(decoder.decompress(bytes(data[at:end]))), None
            except (ValueError, zstandard.ZstdError) as error:
                yield number, None, str(error)
            number += 1
        at = end


def typed(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``page_id, url, payload, digest, first, revisit``: which rows repeat an earlier payload.

    ``first`` is the smallest ``page_id`` with the payload. Only payloads that occur twice are
    looked up; their list is written first, so Spark knows its size when it chooses the join.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    repeated = (
        rows.where(F.octet_length("payload") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first", F.lit(True).alias("again"))
    )
    repeated.write.parquet(f"{folder}/repeated")
    repeated = pages.sparkSession.read.parquet(f"{folder}/repeated")
    revisit = F.coalesce("again", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(repeated, "digest", "left").select(
        "page_id", "url", "payload", "digest", "first", revisit.alias("revisit")
    )


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of ``typed`` to ``folder/archives``; returns the list of archives, as stored."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, root = FileSystem.from_uri(f"{folder}/archives")
        store.create_dir(root, recursive=True)
        found = (record(*map(lambda c: c.as_py(), row)) for batch in batches for row in zip(*_columns(batch)))
        for number, head in enumerate(found):
            name = f"{context.partitionId():06d}-{context.taskAttemptId()}-{number:04d}.warc.zst"
            count = size = 0

            def some() -> Iterator[bytes]:
                yield head
                while size < archive_bytes and (more := next(found, None)) is not None:
                    yield more

            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                for frame in archive_frames(some()):
                    out.write(frame)
                    size += len(frame)
                    count += 1
            yield pa.RecordBatch.from_pydict({"archive": [name], "frames": [count], "bytes": [size]})

    def _columns(batch: pa.RecordBatch) -> list:
        return [batch[c] for c in ("page_id", "url", "payload", "digest", "first", "revisit")]

    rows.mapInArrow(write, "archive string, frames long, bytes long").write.parquet(f"{folder}/list")
    return rows.sparkSession.read.parquet(f"{folder}/list")


def read_archives(
    spark: SparkSession, folder: str, listed: DataFrame | None = None, with_payload: bool = True
) -> DataFrame:
    """One row per record frame of the archives in ``folder``; see ``RECORD``.

    ``listed``, as ``write_archives`` returns it, restricts them; it has one short row for each
    ``ARCHIVE_BYTES`` of archive, so it is broadcast: the archives themselves stay where they are.
    ``payload`` is null for revisits. A record or frame that fails a check gives a row with
    ``error`` and no other field; after a broken frame the rest of that archive cannot be found.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("archive", pa.string()), ("frame", pa.int64()), ("page_id", pa.int64()), ("url", pa.string())]
            + [("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64())]
            + [("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())]
        )
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"]):
                found = records(content.as_py())
                while part := list(islice(found, 500)):
                    rows = [
                        (path, frame, *(row or (None,) * 7)[: 6 + with_payload], *(() if with_payload else (None,)), error)
                        for frame, row, error in part
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                    )

    files = spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary"
    )
    found = files.option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")
    if listed is not None:
        name = F.element_at(F.split("path", "/"), -1)
        found = found.join(F.broadcast(listed.select("archive")), name == F.col("archive"), "left_semi")
    return found.mapInArrow(read, RECORD)


def round_trip(pages: DataFrame, with_payload: bool = True) -> DataFrame:
    """Write ``page_id, url, html`` as archives and read them again; see ``RECORD``.

    Of rows with equal payloads of at least ``MIN_REVISIT`` bytes those with the smallest
    ``page_id`` are responses and the others revisits; null ids come last. A null html is an
    empty payload; a null url has no field. An empty table makes no archive and gives no row.
    """
    spark = pages.sparkSession
    folder = fresh_folder(spark, "warc")
    listed = write_archives(typed(pages, folder), folder)
    if listed.isEmpty():
        return spark.createDataFrame([], RECORD)
    return read_archives(spark, f"{folder}/archives", listed, with_payload)
