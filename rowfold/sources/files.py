"""Parquet sources, scan units and file positions. Paths may be any URI the cluster can read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.operators.positions import ROW_GROUP_SPAN
from rowfold.session import path_exists
from rowfold.sources.footers import can_read_footers, row_group_listing

FILE_PATH = "_metadata.file_path"
ROW_INDEX = "_metadata.row_index"

# Files that can be numbered in one go: their list (some 100 bytes each) goes to every task.
MOST_FILES = 100_000


def read_parquet(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*paths)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one when nothing was written there yet."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return empty_table(spark, schema)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    # known to be empty when a query is planned, so that joins with it are left out
    return spark.createDataFrame([], schema).limit(0)


def local_table(spark: SparkSession, rows: Iterable, schema: T.StructType) -> DataFrame:
    """A few local rows under an explicit schema; large tables come from files or ``spark.range``."""
    return spark.createDataFrame(list(rows), schema)


def scan_units(df: DataFrame) -> DataFrame:
    """The splits a file scan is cut into, with their row counts; reads no data columns."""
    return (
        df.select(
            F.col(FILE_PATH).alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
        )
        .groupBy("file_path", "block_start")
        .agg(F.count("*").alias("rows"))
    )


def row_groups(df: DataFrame, path: str | None = None) -> DataFrame:
    """One numbered group per file, in path order: ``row_group, file_path, rows, bytes, bytes_before``.

    With ``path``, the folder that ``df`` reads, rows and bytes come from the footers and nothing is scanned; a folder that only
    Spark's readers can open is scanned without any column, and has no bytes (0). One task numbers the files, a row of some
    100 bytes for each. Files without rows are left out.
    """
    if path is not None and can_read_footers(path):
        listing = row_group_listing(df.sparkSession, path)
        files = listing.groupBy("file_path").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).filter("rows > 0")
    else:
        files = df.select(F.col(FILE_PATH).alias("file_path")).groupBy("file_path").agg(F.count("*").alias("rows"))
        files = files.withColumn("bytes", F.lit(0).cast("long"))
    # one row per file
    by_path = Window.orderBy("file_path")
    number, before = F.row_number().over(by_path) - F.lit(1), F.sum("bytes").over(by_path.rowsBetween(Window.unboundedPreceding, -1))
    return files.select(
        number.cast("bigint").alias("row_group"), "file_path", "rows", "bytes", F.coalesce(before, F.lit(0)).alias("bytes_before")
    )


def with_file_position(df: DataFrame, groups: DataFrame, group_count: int, name: str = "position") -> DataFrame:
    """Add each row's position from its file and its place in it; needs no sort and no shuffle.

    Only rows of the files in ``groups`` stay; there may be ``MOST_FILES`` of them at most.
    """
    if group_count > MOST_FILES:
        raise ValueError(f"number at most {MOST_FILES} files at a time, not {group_count}")
    listed = groups.agg(F.min("file_path"), F.max("file_path")).first()
    if listed[0] is not None:
        # files outside are not even opened
        df = df.filter(F.col(FILE_PATH).between(*listed))
    numbers = F.broadcast(groups.select(F.col("file_path").alias("_path"), F.col("row_group").alias("_group")))
    placed = df.select("*", F.col(FILE_PATH).alias("_file"), F.col(ROW_INDEX).alias("_index"))
    return (
        placed.join(numbers, F.col("_file") == F.col("_path"))
        .withColumn(name, F.col("_group") * F.lit(ROW_GROUP_SPAN) + F.col("_index"))
        .drop("_file", "_path", "_group", "_index")
    )
