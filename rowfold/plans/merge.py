"""A table of files with disjoint key ranges: a merge rewrites the files that hold touched keys and takes over the others.

Files are cut by the first key column, which has to be a number, a day or a time. A manifest for each version lists the files with their
ranges; a version counts once its commit file exists, which only one writer can create. Readers of the version before keep
their files.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowfold.functions.hashing import quote
from rowfold.operators.joins import upsert
from rowfold.session import create_new, list_names, path_exists, read_text
from rowfold.sinks.clustered import as_number

FILE_ROWS = 1_000_000


@dataclass(frozen=True)
class MergeTable:
    """Where the table is, and its key; the first column cuts the files."""

    root: str
    keys: tuple[str, ...]
    file_rows: int = FILE_ROWS

    def manifest(self, name: str) -> str:
        return f"{self.root}/manifests/{name}"

    def commit(self, version: int) -> str:
        return f"{self.root}/versions/{version}"


@dataclass(frozen=True)
class Merged:
    """What a merge did: files before, files rewritten, files after."""

    version: int
    before: int
    rewritten: int
    after: int


def current_version(spark: SparkSession, table: MergeTable) -> int:
    """0 if nothing was written yet."""
    return max((int(n) for n in list_names(spark, f"{table.root}/versions")), default=0)


def manifest(spark: SparkSession, table: MergeTable, version: int) -> DataFrame:
    """``file_path, least, most, rows`` of a version; bounds are numbers that sort like the first key column."""
    return spark.read.parquet(table.manifest(read_text(spark, table.commit(version))))


def read_table(spark: SparkSession, table: MergeTable, version: int | None = None) -> DataFrame:
    version = version or current_version(spark, table)
    if not version:
        raise ValueError(f"nothing was written to {table.root}")
    # one name for each file
    return spark.read.parquet(*[r["file_path"] for r in manifest(spark, table, version).select("file_path").collect()])


def _write(spark: SparkSession, table: MergeTable, rows: DataFrame, files: int, cuts: Sequence[float] = ()) -> DataFrame:
    """Write rows as files that do not overlap and do not cross a cut; returns their entries of the manifest."""
    folder = f"{table.root}/data/{uuid.uuid4().hex}"
    first = quote(table.keys[0])
    # by the range and the first key column alone, so that rows with one value of it are in one file
    ranged = _ranged(rows, table.keys[0], cuts).repartitionByRange(max(1, files), "range", first)
    ranged.sortWithinPartitions("range", *map(quote, table.keys)).write.partitionBy("range").parquet(folder)
    written = spark.read.schema(rows.schema).parquet(folder)
    number = as_number(written, table.keys[0])
    return written.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.min(number).alias("least"), F.max(number).alias("most"), F.count("*").alias("rows")
    )


def _commit(spark: SparkSession, table: MergeTable, entries: DataFrame, version: int) -> None:
    """Write a manifest of its own and name it in the commit file."""
    name = f"{version}-{uuid.uuid4().hex}"
    entries.coalesce(1).write.parquet(table.manifest(name))
    try:
        create_new(spark, table.commit(version), name)
    except Py4JJavaError as error:
        if not path_exists(spark, table.commit(version)):
            raise
        raise RuntimeError(f"version {version} of {table.root} was written by another writer") from error


def create_table(rows: DataFrame, table: MergeTable) -> int:
    """Write the first version; returns the number of its files."""
    spark = rows.sparkSession
    if current_version(spark, table):
        raise ValueError(f"{table.root} holds a table already")
    entries = _write(spark, table, rows, -(-rows.count() // table.file_rows))
    _commit(spark, table, entries, 1)
    return manifest(spark, table, 1).count()


def _ranged(rows: DataFrame, key: str, cuts: Sequence[float]) -> DataFrame:
    """Rows with the number of the file range they fall into (``range``); -1 for a null key."""
    numbered = rows.withColumn("_number", as_number(rows, key))
    if cuts:
        splits = [float("-inf"), *cuts, float("inf")]
        numbered = Bucketizer(splits=splits, inputCol="_number", outputCol="range", handleInvalid="keep").transform(numbered)
    else:
        numbered = numbered.withColumn("range", F.lit(0))
    known = F.when(F.col("_number").isNull(), F.lit(-1)).otherwise(F.col("range")).cast("int")
    return numbered.withColumn("range", known).drop("_number")


def merge_rows(new: DataFrame, table: MergeTable) -> Merged:
    """Put ``new`` in place of, or next to, the rows with its keys; keys in ``new`` come once.

    Files whose range holds no new key are neither read nor written. What is rewritten is cut anew, so files do not outgrow their
    size, and stays inside the ranges of the files it replaces. A null key equals no other; rows without one go into files of their own.
    """
    spark = new.sparkSession
    version = current_version(spark, table)
    entries = manifest(spark, table, version)
    held = entries.filter("least IS NOT NULL").orderBy("least").collect()
    before = entries.count()
    # a file holds everything from its least key up to the next file's; the first one also what lies before
    cuts = [r["least"] for r in held[1:]]
    touched = {r["range"] for r in _ranged(new, table.keys[0], cuts).select("range").distinct().collect()}
    if not touched:
        return Merged(version, before, 0, before)
    old = [r for k, r in enumerate(held) if k in touched]
    names = [r["file_path"] for r in old]
    rows = new
    if names:
        schema = read_table(spark, table, version).schema
        rows = upsert(spark.read.schema(schema).parquet(*names), new, list(table.keys))
    size = sum(r["rows"] for r in old) + new.count()
    fresh = _write(spark, table, rows, -(-size // table.file_rows), cuts)
    kept = entries.filter(~F.col("file_path").isin(names)) if names else entries
    _commit(spark, table, kept.unionByName(fresh), version + 1)
    return Merged(version + 1, before, len(names), manifest(spark, table, version + 1).count())
