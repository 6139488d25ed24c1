"""Streams of JSON lines admitted by records: at most so many a micro-batch, wherever files begin and end."""

from __future__ import annotations

import bisect
import itertools
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowfold.session import create_new, path_exists, read_text

RECORDS_PER_TRIGGER = 100_000
FORMAT = "line_slices"
# Bytes of lines that one task reads, about.
SLICE_BYTES = 8 << 20
# Records of a micro-batch for which another task is worth its start.
TASK_RECORDS = 16_384
# Micro-batches for which another stream is worth its start.
STREAM_BATCHES = 16


def _line_slices():
    """The source: rows are slices of files, not lines. Made in a function, so that it travels by value."""
    from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

    class LineSlices(DataSource):
        """Options: ``path`` a local folder or a URI that Arrow can open, ``records`` a trigger, ``starting`` earliest, latest, a time or an
        offset, ``until`` an offset, if the stream ends.

        Files are written once and do not grow; they come in the order of their times and names. An offset is a file and a byte in
        it behind a line. ``starting`` as a time leaves out files last modified before it.
        """

        @classmethod
        def name(cls) -> str:
            return "line_slices"

        def schema(self) -> str:
            return "file string, first long, stop long, records long"

        def simpleStreamReader(self, schema):
            return Reader(self.options)

    class Reader(SimpleDataSourceStreamReader):
        def __init__(self, options) -> None:
            self.path, self.records = options["path"], int(options.get("records", "100000"))
            self.starting, self.slice_bytes = options.get("starting", "earliest"), int(options.get("slicebytes", str(8 << 20)))
            self.until = options.get("until")

        def files(self) -> list[tuple[float, str, int]]:
            import re

            from pyarrow import fs

            local = re.match(r"^(?:file:/*)?(/.*)$", self.path)
            self.system, root = (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(self.path)
            found = self.system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
            plain = [f for f in found if f.type == fs.FileType.File and not re.search(r"/[_.][^/]*$", f.path)]
            return sorted((f.mtime_ns / 1e9 if f.mtime_ns else 0.0, f.path, f.size) for f in plain)

        def initialOffset(self) -> dict:
            import json
            from datetime import datetime, timezone

            if self.starting.startswith("{"):
                return json.loads(self.starting)
            if self.starting == "earliest":
                return {"time": "0", "file": "", "byte": 0}
            if self.starting == "latest":
                files = self.files()
                return {"time": repr(files[-1][0]), "file": files[-1][1], "byte": files[-1][2]} if files else {"time": "0", "file": "", "byte": 0}
            since = datetime.fromisoformat(self.starting)
            since = since if since.tzinfo else since.replace(tzinfo=timezone.utc)
            return {"time": repr(since.timestamp()), "file": "", "byte": 0}

        def slices(self, start: dict, left: int, end: dict | None = None):
            """Slices of whole lines behind ``start``, ``left`` lines at most or up to ``end``, and the offset behind them."""
            out, at = [], dict(start)
            for time, path, size in self.files():
                key, stop = (time, path), size
                if path == start["file"]:
                    first = start["byte"]
                elif key <= (float(start["time"]), start["file"]):
                    continue
                else:
                    first = 0
                if end is not None:
                    if path == end["file"]:
                        stop = end["byte"]
                    elif key > (float(end["time"]), end["file"]):
                        break
                with self.system.open_input_file(path) as file:
                    file.seek(first)
                    place, begun, done, lines = first, first, first, 0
                    while place < stop and left > 0:
                        block = file.read(min(1 << 20, stop - place))
                        found = block.find(b"\n")
                        while found >= 0 and left > 0:
                            lines, left, done = lines + 1, left - 1, place + found + 1
                            found = block.find(b"\n", found + 1)
                        place += len(block)
                        if lines and done - begun >= self.slice_bytes:
                            out.append((path, begun, done, lines))
                            begun, lines = done, 0
                    if left > 0 and done < stop:
                        # the last line has no end
                        lines, left, done = lines + 1, left - 1, stop
                    if lines:
                        out.append((path, begun, done, lines))
                at = {"time": repr(time), "file": path, "byte": done}
                if left <= 0:
                    break
            return out, at

        def read(self, start: dict):
            import json

            found, end = self.slices(start, self.records, json.loads(self.until) if self.until else None)
            return iter(found), end

        def readBetweenOffsets(self, start: dict, end: dict):
            return iter(self.slices(start, 1 << 62, end)[0])

    return LineSlices


def _line_reader() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for row in batch.to_pylist():
                local = re.match(r"^(/.*)$", row["file"])
                system, name = (fs.LocalFileSystem(), row["file"]) if local else fs.FileSystem.from_uri(row["file"])
                with system.open_input_file(name) as file:
                    file.seek(row["first"])
                    lines = file.read(row["stop"] - row["first"]).removesuffix(b"\n").split(b"\n")
                yield pa.RecordBatch.from_arrays([pa.array([x.removesuffix(b"\r") for x in lines], pa.binary())], names=["value"])

    return run


def read_records(
    spark: SparkSession,
    path: str,
    records: int = RECORDS_PER_TRIGGER,
    starting: str = "earliest",
    slice_bytes: int = SLICE_BYTES,
    tasks: int | None = None,
    until: str | None = None,
) -> DataFrame:
    """Stream of lines as binary ``value``, at most ``records`` in each micro-batch.

    What the driver handles are slices: it looks for line ends in the next ``records`` lines and no further. Tasks read the lines. A
    query that starts again goes on at its checkpoint, within a file if need be. Run it with a ``continuous`` trigger:
    one that takes what is available takes a single micro-batch.

    ``tasks`` read a micro-batch, by default one for ``TASK_RECORDS`` of ``records`` and at most as many as shuffles have partitions.
    A single task reads its slices one after the other and without a shuffle; lines of many kilobytes are worth more tasks.

    Micro-batches of a stream come one after the other: for a backlog of many of them see :func:`record_ranges`, which gives ``starting``
    and ``until``.
    """
    if tasks is None:
        tasks = min(-(-records // TASK_RECORDS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.dataSource.register(_line_slices())
    reader = spark.readStream.format(FORMAT).option("path", path).option("records", str(records)).option("starting", starting)
    reader = reader if until is None else reader.option("until", until)
    slices = reader.option("sliceBytes", str(slice_bytes)).load()
    # slices are dealt to tasks anew; the source hands them over in one partition
    dealt = slices.repartition(tasks, F.col("file"), F.col("first")) if tasks > 1 else slices
    return dealt.mapInArrow(_line_reader(), "value binary")


def _line_counter() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines that end in a piece, and the byte behind its line number ``nth`` if there is one; a file's last line may have no end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import numpy as np
        import pyarrow as pa
        from pyarrow import fs

        schema = pa.schema([("number", pa.int64()), ("lines", pa.int64()), ("at", pa.int64())])
        for batch in batches:
            for row in batch.to_pylist():
                local = re.match(r"^(/.*)$", row["file"])
                system, name = (fs.LocalFileSystem(), row["file"]) if local else fs.FileSystem.from_uri(row["file"])
                with system.open_input_file(name) as file:
                    file.seek(row["first"])
                    data = np.frombuffer(file.read(row["stop"] - row["first"]), np.uint8)
                ends = np.flatnonzero(data == 10) + 1
                if row["last"] and len(data) and data[-1] != 10:
                    ends = np.append(ends, len(data))
                at = int(row["first"] + ends[row["nth"] - 1]) if row["nth"] else None
                yield pa.RecordBatch.from_pylist([{"number": row["number"], "lines": len(ends), "at": at}], schema)

    return run


def _count_lines(spark: SparkSession, pieces: list[tuple], most: int) -> list[tuple[int, int | None]]:
    """Of each (file, first, stop, last, nth) what :func:`_line_counter` says, read in tasks."""
    rows = [(i, *piece) for i, piece in enumerate(pieces)]
    df = spark.createDataFrame(rows, "number long, file string, first long, stop long, last boolean, nth long")
    found = df.repartition(min(len(rows), most)).mapInArrow(_line_counter(), "number long, lines long, at long")
    return [(r["lines"], r["at"]) for r in sorted(found.collect(), key=lambda r: r["number"])]


def record_ranges(
    spark: SparkSession,
    path: str,
    plan: str,
    records: int = RECORDS_PER_TRIGGER,
    starting: str = "earliest",
    streams: int | None = None,
    slice_bytes: int = SLICE_BYTES,
) -> list[tuple[str, str | None]]:
    """``starting`` and ``until`` of streams of :func:`read_records` that share what lies in ``path``, each with a checkpoint of its own.

    All but the last stream take whole micro-batches of ``records`` lines, so there are as many micro-batches as in one stream. The
    last has no end: it goes on with files that come later. Order holds within a stream. The first call writes the ranges to the file
    ``plan``, and later calls return the same, whatever has come since; keep it beside the checkpoints.

    Lines are counted in tasks; the driver sees a row for ``slice_bytes``. There are ``streams`` at most, by default one for each core,
    and one for ``STREAM_BATCHES`` micro-batches.
    """
    if not path_exists(spark, plan):
        reader = _line_slices()({"path": path, "starting": starting}).simpleStreamReader(None)
        start = reader.initialOffset()
        streams = spark.sparkContext.defaultParallelism if streams is None else streams
        behind, pieces = (float(start["time"]), start["file"]), []
        for time, file, size in reader.files() if streams > 1 else []:
            if (time, file) < behind:
                continue
            first = start["byte"] if file == start["file"] else 0
            for low in range(first, size, slice_bytes):
                high = min(low + slice_bytes, size)
                pieces.append((time, (file, low, high, high == size)))
        most = int(spark.conf.get("spark.sql.shuffle.partitions"))
        counts = [lines for lines, _ in _count_lines(spark, [(*piece, 0) for _, piece in pieces], most)] if pieces else []
        sums = list(itertools.accumulate(counts))
        batches = -(-sums[-1] // records) if sums else 0
        streams = max(1, min(streams, batches // STREAM_BATCHES))
        # a cut is behind a line: the piece in which that line ends, and its number there
        cuts = []
        for i in range(1, streams):
            line = batches * i // streams * records
            k = bisect.bisect_left(sums, line)
            cuts.append((k, line - sums[k] + counts[k]))
        found = _count_lines(spark, [(*pieces[k][1], nth) for k, nth in cuts], most) if cuts else []
        ends = [json.dumps({"time": repr(pieces[k][0]), "file": pieces[k][1][0], "byte": at}) for (k, _), (_, at) in zip(cuts, found)]
        create_new(spark, plan, json.dumps(list(zip([json.dumps(start), *ends], [*ends, None]))))
    return [(first, stop) for first, stop in json.loads(read_text(spark, plan))]
