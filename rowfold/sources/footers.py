"""Row groups of Parquet files from their footers, which tasks read; no data page is touched."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTING_SCHEMA = (
    "file_path string, row_group int, first_row long, rows long, bytes long, least string, most string"
)
# Footers that one task reads, about.
FOOTERS_PER_TASK = 64
#: Schemes that tasks can open by themselves.
READABLE = ("file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")


def can_read_footers(path: str) -> bool:
    """Whether tasks can open the files of a path by themselves: some schemes only Spark's own readers know."""
    scheme = path.split(":", 1)[0] if "://" in path or path.startswith("file:") else "file"
    return scheme in READABLE


def row_group_listing(spark: SparkSession, path: str, column: str | None = None) -> DataFrame:
    """Every row group below ``path``: file, number in it, rows before it in the file, rows, bytes, and a column's bounds.

    ``least`` and ``most`` are the statistics of ``column`` as text, null where the footer has none. Hidden files are left
    out as Spark's readers do. Files are listed by Spark; their contents are not read, but for the footers.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    paths = found.select(F.col("_metadata.file_path").alias("path"))
    spread = paths.repartition(max(1, -(-paths.count() // FOOTERS_PER_TASK)), "path")
    return spread.mapInArrow(_footer_reader(column), LISTING_SCHEMA)


def _footer_reader(column: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # self-contained, for workers that do not have this package
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re
        from urllib.parse import unquote

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["file_path", "row_group", "first_row", "rows", "bytes", "least", "most"]
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                # Spark's names of files are encoded as in URLs
                plain = unquote(path)
                local = re.match(r"^file:/*(/.*)$", plain)
                system, name = (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(plain.replace("s3a://", "s3://", 1))
                with system.open_input_file(name) as file:
                    meta = pq.read_metadata(file)
                at = next((k for k in range(meta.num_columns) if meta.schema.column(k).path == column), None)
                first = 0
                for k in range(meta.num_row_groups):
                    group = meta.row_group(k)
                    bounds = group.column(at).statistics if at is not None else None
                    has = bounds is not None and bounds.has_min_max
                    ends = (str(bounds.min), str(bounds.max)) if has else (None, None)
                    rows.append((path, k, first, group.num_rows, group.total_byte_size, *ends))
                    first += group.num_rows
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def groups_between(listing: DataFrame, first: int, stop: int) -> DataFrame:
    """The groups of a listing that hold rows ``first`` to ``stop`` of their files; the others need not be opened."""
    return listing.filter((F.col("first_row") < stop) & (F.col("first_row") + F.col("rows") > first))
