"""Parquet sinks and table layouts."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.functions.hashing import quote
from rowfold.session import make_dir


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    num_files: int | None = None,
    max_records_per_file: int | None = None,
    partition_by: Sequence[str] = (),
    codec: str = "snappy",
) -> None:
    """Write Parquet in parallel; ``num_files`` asks for that many files and is meant for small results."""
    if num_files is not None:
        df = df.repartition(num_files)
    writer = df.write.mode(mode).option("compression", codec)
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite", **options) -> None:
    """One directory per value of ``columns``.

    Rows of a value are brought together first, so a directory gets few files; the rebalance step
    splits a value that holds a large part of the table over several tasks.
    """
    write_table(df.hint("rebalance", *columns), path, mode, partition_by=columns, **options)


def write_sorted(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    mode: str = "overwrite",
    bloom_columns: Sequence[str] = (),
    cluster: bool = False,
) -> None:
    """Sort rows inside each file so that row-group statistics let scans skip.

    ``cluster`` range-partitions by the columns first, which makes skipping work across files too. Rows
    of one value are told apart by the task that read them, so a value that holds a large part of the
    table is split over several ranges.
    ``bloom_columns`` get Parquet bloom filters, for look-ups by columns the sort does not serve.
    """
    if cluster:
        tied = df.withColumn("_task", F.spark_partition_id())
        df = tied.repartitionByRange(*[F.col(quote(c)) for c in columns], "_task").drop("_task")
    writer = df.sortWithinPartitions(*[F.col(quote(c)) for c in columns]).write.mode(mode)
    for column in bloom_columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.option("compression", "snappy").parquet(path)


def write_bucketed(
    df: DataFrame, table: str, path: str, key: str, buckets: int, mode: str = "overwrite"
) -> None:
    """External table bucketed and sorted by ``key``: joins on it need no shuffle of this side."""
    (
        df.write.mode(mode)
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )


def bucketed_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, key: str, buckets: int
) -> str:
    """Name of the bucketed table at ``path``, which is made, or made known to this session, if need be.

    Fill it with ``insertInto``. The files carry their bucket in their names, so any session can take them up.
    """
    if not spark.catalog.tableExists(name):
        make_dir(spark, path)
        fields = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {quote(name)} ({fields}) USING parquet CLUSTERED BY ({quote(key)}) INTO {buckets} BUCKETS "
            f"LOCATION '{path}'"
        )
    # another session may have written to it
    spark.catalog.refreshTable(name)
    return name


def show(df: DataFrame, rows: int = 20) -> None:
    df.show(rows, truncate=False)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan of a query as text."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
