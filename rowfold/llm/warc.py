"""Writing pages as gzipped WARC records, and reading archives by byte ranges.

*Writing.* Each task writes an archive of its own, one gzip member per record, and reports it in a manifest that Spark
commits; files of lost attempts are in no manifest and are never read. Among records with equal payloads of at least
``REVISIT_BYTES``, the one with the largest page id is a response and the others are revisits that refer to it.

*Reading.* Archives are cut into byte ranges, whatever the records' bounds, and each range is a row that any task can take.
A task looks for gzip magic in its range, tries to decode the candidate, and takes it for a record only if it starts with
WARC headers that give a length, holds that length, and its checksum is right. Otherwise it was data that looks like the
magic, and the search goes on behind it. A range owns the records that start inside; the last one is read past the end.

A null or empty html is an empty payload. A null page id is written as none and comes back as null; it counts as smaller than
any other. Of equal rows with the largest id exactly one is the response. Line breaks and control characters in a URL are
percent-encoded in its header. Columns other than id, url and html are not written.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.session import new_work_dir, stage

RESPONSE, REVISIT = "response", "revisit"
REVISIT_BYTES = 1000
RANGE_BYTES = 8 << 20
# Tasks that ranges are spread over at most; beyond it a task takes several.
MOST_TASKS = 20_000
_MAGIC = b"\x1f\x8b\x08"
_STEP = 1 << 20
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LEVEL = 6


def file_system(path: str):
    """A file system that tasks can open the path's files by, and the path in it."""
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def record_name(number: int, space: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{space}/{number}')}>"


def _digest(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    """One gzip member."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    data = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    gzip = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return gzip.compress(data) + gzip.flush()


def page_record(row: dict, space: str) -> bytes:
    """The record of a page with ``number, page_id, url, html`` and, for a revisit, ``refers_number``."""
    payload = row["html"] or b""
    revisit = row["refers_number"] is not None
    headers = {"WARC-Type": REVISIT if revisit else RESPONSE, "WARC-Record-ID": record_name(row["number"], space), "WARC-Date": _DATE}
    if row["url"] is not None:
        headers["WARC-Target-URI"] = _clean(row["url"])
    if row["page_id"] is not None:
        headers["X-Page-ID"] = str(row["page_id"])
    headers["WARC-Payload-Digest"] = _digest(payload)
    headers["Content-Type"] = "application/http; msgtype=response"
    if revisit:
        headers["WARC-Refers-To"] = record_name(row["refers_number"], space)
        headers["WARC-Profile"] = _PROFILE
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return record_bytes(headers, http if revisit else http + payload)


def write_pages(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = REVISIT_BYTES,
) -> DataFrame:
    """Write archives into ``folder``; returns the manifest: ``path, bytes, records`` of each."""
    spark = pages.sparkSession
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.col(f"`{html_col}`").cast("binary").alias("html"),
    )
    # written down, so that a row keeps its number
    numbered = rows.withColumn("number", F.monotonically_increasing_id())
    numbered.write.option("compression", "zstd").parquet(f"{folder}/numbered")
    rows = spark.read.schema(numbered.schema).parquet(f"{folder}/numbered")
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    payloads = rows.filter(size >= least_bytes).select("number", "page_id", F.sha2("html", 256).alias("payload"))
    same = payloads.groupBy("payload").agg(F.max(F.struct("page_id", "number")).alias("last"), F.count("*").alias("n")).filter("n > 1")
    revisits = payloads.join(same, "payload").filter(F.col("number") != F.col("last.number"))
    revisits = revisits.select("number", F.col("last.number").alias("refers_number"))
    records = rows.join(revisits, "number", "left")
    place = f"{folder}/archives"
    space = uuid.uuid5(uuid.NAMESPACE_URL, folder).hex

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, root = file_system(place)
        system.create_dir(root, recursive=True)
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        done = size = 0
        with system.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in batches:
                for k in range(batch.num_rows):
                    member = page_record({c: batch.column(c)[k].as_py() for c in batch.schema.names}, space)
                    out.write(member)
                    done, size = done + 1, size + len(member)
        told = [pa.array([f"{place}/{name}"]), pa.array([size], pa.int64()), pa.array([done], pa.int64())]
        yield pa.RecordBatch.from_arrays(told, names=["path", "bytes", "records"])

    return stage(records.mapInArrow(write, "path string, bytes long, records long"), folder, "manifest")


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes
    end: int


class ByteRange:
    """A range of a file, read further as records need it."""

    def __init__(self, file, start: int, stop: int, size: int) -> None:
        self.file, self.start, self.stop, self.size = file, start, stop, size
        # two bytes more, for magic that begins at the end of the range
        self.data = bytearray(self._read(start, min(size, stop + len(_MAGIC) - 1)))

    def _read(self, start: int, stop: int) -> bytes:
        self.file.seek(start)
        return self.file.read(stop - start)

    def piece(self, at: int, size: int) -> bytes:
        """Up to ``size`` bytes from file position ``at``; empty at the end of the file."""
        while at >= self.start + len(self.data):
            end = self.start + len(self.data)
            if end >= self.size:
                return b""
            self.data += self._read(end, min(self.size, end + _STEP))
        return bytes(self.data[at - self.start : at - self.start + size])

    def find(self, at: int) -> int | None:
        """The next gzip magic at or behind ``at`` that begins inside the range."""
        found = self.data.find(_MAGIC, at - self.start, self.stop - self.start + len(_MAGIC) - 1)
        return None if found < 0 else found + self.start


def _headers(data: bytes) -> tuple[dict[str, str], int] | None:
    """Headers of a record up to the blank line that ``data`` ends with, and the place behind it."""
    lines = data[:-4].decode("utf-8", "replace").split("\r\n")
    pairs = [line.partition(":") for line in lines[1:]]
    headers = {name.strip().lower(): value.strip() for name, _, value in pairs}
    length = headers.get("content-length", "")
    return (headers, len(data)) if length.isdecimal() and "warc-type" in headers else None


def decode_record(source: ByteRange, at: int) -> Record | None:
    """The record of the gzip member at ``at``, or None if there is none."""
    unzip, out, place = zlib.decompressobj(31), bytearray(), at
    known = None
    try:
        while not unzip.eof:
            piece = source.piece(place, 1 << 16)
            if not piece:
                return None
            seen = max(0, len(out) - 3)
            out += unzip.decompress(piece)
            place += len(piece)
            if not b"WARC/1.".startswith(out[:7]) and not out.startswith(b"WARC/1."):
                return None
            # headers may be of any length; they end with a blank line
            if known is None and (blank := out.find(b"\r\n\r\n", seen)) >= 0:
                known = _headers(bytes(out[: blank + 4]))
                if known is None:
                    return None
    except zlib.error:
        return None
    if known is None:
        return None
    headers, body = known
    length = int(headers["content-length"])
    if len(out) < body + length:
        return None
    return Record(at, headers, bytes(out[body : body + length]), place - len(unzip.unused_data))


def range_records(source: ByteRange) -> Iterator[Record]:
    """Records that start inside the range."""
    at = source.find(source.start)
    while at is not None:
        record = decode_record(source, at)
        if record is not None:
            yield record
        after = record.end if record else at + 1
        at = source.find(after) if after < source.stop else None


def payload_of(record: Record) -> bytes:
    """What follows the HTTP headers of an ``application/http`` block, or the whole block."""
    if not record.headers.get("content-type", "").startswith("application/http"):
        return record.block
    return record.block.partition(b"\r\n\r\n")[2]


RECORD_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("refers_to_id", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
    ]
)


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the archives in ``path, bytes``, read by ranges of ``range_bytes``; columns of ``RECORD_SCHEMA``."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start")
    ranges = files.filter("bytes > 0").select("path", "bytes", starts)
    # a range is a few bytes here and some megabytes of work, so tasks are counted by ranges and not by bytes
    count = files.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    spread = ranges.repartition(min(int(count), MOST_TASKS), F.xxhash64("path", "start"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "start")), strict=True):
                system, inner = file_system(path)
                with system.open_input_file(inner) as file:
                    held, weight = [], 0
                    for record in range_records(ByteRange(file, start, min(size, start + range_bytes), size)):
                        held.append(record)
                        weight += len(record.block)
                        if weight >= 4 << 20:
                            yield _record_batch(path, held)
                            held, weight = [], 0
                    if held:
                        yield _record_batch(path, held)

    return spread.mapInArrow(scan, RECORD_SCHEMA)


def _record_batch(path: str, records: list[Record]) -> pa.RecordBatch:
    header = lambda name: pa.array([r.headers.get(name) for r in records], pa.string())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([path] * len(records)),
            pa.array([r.offset for r in records], pa.int64()),
            header("warc-type"),
            header("warc-record-id"),
            header("warc-refers-to"),
            pa.array([list(r.headers.items()) for r in records], pa.map_(pa.string(), pa.string())),
            pa.array([payload_of(r) for r in records], pa.binary()),
        ],
        names=RECORD_SCHEMA.fieldNames(),
    )


def resolved(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record.

    A revisit has no payload of its own; its size, digest and page are those of the record it refers to.
    """
    page = F.element_at("headers", F.lit("x-page-id")).cast("long")
    narrow = records.select(
        page.alias("page_id"),
        "record_type",
        "record_id",
        "refers_to_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )
    narrow = stage(narrow, new_work_dir(records.sparkSession, "warc-read"), "records")
    told = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    own = narrow.filter(F.col("record_type") != REVISIT).select(*told, F.lit(None).cast("long").alias("refers_to"))
    targets = narrow.filter(F.col("record_type") != REVISIT).select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest"
    )
    again = narrow.filter(F.col("record_type") == REVISIT).select("page_id", "record_type", "refers_to_id")
    return own.unionByName(again.join(targets, "refers_to_id", "left").select(*told, "refers_to"))


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write pages, read the archives back, and resolve revisits."""
    manifest = write_pages(pages, folder or new_work_dir(spark, "warc"))
    return resolved(read_archives(manifest, range_bytes))
