"""Token ids as Parquet list columns, laid out for selective reads.

Documents are stored in ascending id order, range-partitioned over files named in that order. Each row holds the id, the
number of tokens, the checksum and the list of token ids. Row groups are of even size, the page index (written by Spark's
Parquet writer for every file) bounds the document ids of each page, integers that ascend are stored as differences
(``DELTA_BINARY_PACKED``) and token ids by dictionary, or as differences where the dictionary grows too large. A reader of
the metadata columns touches no token page; one of an id range touches only the pages that hold it.

``start`` positions are not stored: they follow from the counts, file by file (:func:`read_back`).

A null text counts as an empty one and stores only the end id. Rows with a null id come first; rows with equal ids are
ordered by their text's hash, rows that are equal in both are interchangeable. Columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.llm.flat import FlatTexts, map_texts
from rowfold.llm.units import byte_units
from rowfold.session import new_work_dir, stage

END_ID = 2
# A row group is what a task reads, a page the least that a selective read decodes.
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 256 << 10, 2_000
RUN_BITS = 16
# Documents of a file, about, where the number of files is not given.
FILE_ROWS = 16_384

ENCODED_SCHEMA = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)
_CHECKED_SCHEMA = [
    T.StructField("file_number", T.LongType()),
    T.StructField("row_index", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
]


def checksums(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of each list of ids as little-endian 32-bit integers."""
    # a view: the ids of a slice are not copied
    whole = memoryview(np.ascontiguousarray(ids, "<i4")).cast("B")
    return np.array([zlib.crc32(whole[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], np.int64)


def _encode(path: str, end_id: int, batch: pa.RecordBatch) -> dict[str, pa.Array | np.ndarray]:
    found = byte_units(path).encode(FlatTexts.of(batch.column("text")))
    ids = np.insert(found.ids, found.bounds[1:], end_id).astype(np.int32)
    bounds = found.bounds + np.arange(len(found.bounds))
    return {
        "n_tokens": np.diff(bounds),
        "ids_crc32": checksums(ids, bounds),
        "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)),
    }


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> DataFrame:
    """``id, n_tokens, ids_crc32, ids``, the end id behind each document's own; keeps the order of rows."""
    return map_texts(docs, lambda b: _encode(path, end_id, b), ENCODED_SCHEMA, text=text_col, keep=[id_col])


def write_token_table(
    docs: DataFrame,
    folder: str,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    files: int | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Encode all documents and write them in ascending order of id, as about ``files`` files.

    By default as many as the cores of the session, or one for ``FILE_ROWS`` documents, whichever is more. The texts are
    sorted, not their ids, and encoding happens once. Ranges of ids that are numbers and do not repeat come from quantiles of the
    ids alone; otherwise they are drawn from the rows, with the text's hash, which spreads many rows with one id.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias(text_col))
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    if files is None:
        files = max(docs.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // FILE_ROWS))
    repeated = not rows.groupBy(key).count().filter("count > 1").isEmpty()
    if repeated or not isinstance(rows.schema[id_col].dataType, T.NumericType):
        order = [key.asc_nulls_first(), F.xxhash64(text)]
        ranged = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    else:
        shares = [k / files for k in range(1, files)]
        found = rows.agg(F.percentile_approx(key.cast("double"), [*shares, 1.0], 10_000).alias("q")).first()["q"]
        cuts = sorted(set((found or [0.0])[:-1] or [0.0]))
        number = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="number_", outputCol="range_", handleInvalid="keep")
        numbered = number.transform(rows.withColumn("number_", key.cast("double")))
        # a null id comes first
        place = F.when(key.isNull(), F.lit(0)).otherwise(F.col("range_").cast("int"))
        ranged = numbered.repartitionById(len(cuts) + 1, place).drop("number_", "range_").sortWithinPartitions(key.asc_nulls_first())
    (
        encode_documents(ranged, path, id_col, text_col, end_id)
        .write.option("parquet.writer.version", "v2")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("compression", "zstd")
        .parquet(folder)
    )


def read_tokens(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The table, or some of its columns; filters on the id reach the page index."""
    table = spark.read.parquet(folder)
    return table.select(*columns) if columns else table


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        new = [pa.array(np.diff(bounds)), pa.array(checksums(ids, bounds - bounds[0] if len(bounds) else bounds))]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("id", "file_number", "row_index")), *new],
            names=["id", *(f.name for f in _CHECKED_SCHEMA)],
        )


def read_back(spark: SparkSession, folder: str, id_col: str = "doc_id", work_dir: str | None = None) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of every stored document, counted and summed anew from its stored ids.

    Files are numbered in id order and so are their rows. Counts are summed per run of 65,536 rows of a file, the sums
    are chained over the runs (the only unpartitioned window, one row per run), then added up inside each run.
    """
    name = F.col("_metadata.file_name")
    part, chunk = (F.regexp_extract(name, p, 1).cast("long") for p in (r"^part-(\d+)", r"-c(\d+)\."))
    stored = read_tokens(spark, folder)
    placed = stored.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.shiftleft(part, 24) + F.coalesce(chunk, F.lit(0))).alias("file_number"),
        F.col("_metadata.row_index").alias("row_index"),
        "ids",
    )
    out = T.StructType([T.StructField("id", stored.schema[id_col].dataType), *_CHECKED_SCHEMA])
    checked = stage(placed.mapInArrow(_check, out), work_dir or new_work_dir(spark, "tokens-read"), "checked")
    rows = checked.withColumn("run", F.shiftright("row_index", RUN_BITS))
    sums = rows.groupBy("file_number", "run").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("file_number", "run").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("file_number", "run", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("file_number", "run").orderBy("row_index").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return inside.join(bases, ["file_number", "run"], "left").select(
        F.col("id").alias(id_col), (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
