"""Layouts that serve filters on several columns at once: a space-filling curve over ranks, and files skipped by their bounds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.functions.hashing import quote

# Ranks are cut to so many bits; the same for every column.
RANK_BITS = 8
RANGES = "_ranges"


def as_number(df: DataFrame, column: str) -> Column:
    """A number that sorts like the column: numbers, days, microseconds, or the first six bytes of a text."""
    value, kind = F.col(quote(column)), df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.substring(F.hex(F.encode(value, "UTF-8")), 1, 12), 12, "0"), 16, 10).cast("double")
    return value.cast("double")


def with_curve(df: DataFrame, columns: Sequence[str], name: str = "_curve", bits: int = RANK_BITS) -> DataFrame:
    """Add the place on the Z curve: the bits of each column's rank, interleaved. Nulls rank last.

    Ranks come from quantiles of all rows (one pass, ``2 ** bits - 1`` values for each column), so a skewed column is cut as evenly
    as an even one.
    """
    if not 2 <= len(columns) <= 4:
        raise ValueError("a curve takes 2 to 4 columns")
    numbered = df.select("*", *[as_number(df, c).alias(f"_n{k}") for k, c in enumerate(columns)])
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = numbered.agg(*[F.percentile_approx(f"_n{k}", shares, 10 << bits).alias(f"_q{k}") for k in range(len(columns))]).first()
    quantiles = [sorted(found[f"_q{k}"] or [0.0]) for k in range(len(columns))]
    cuts = [[float("-inf"), *sorted(set(q)), float("inf")] for q in quantiles]
    inputs = [f"_n{k}" for k in range(len(columns))]
    ranker = Bucketizer(splitsArray=cuts, inputCols=inputs, outputCols=[f"_r{k}" for k in range(len(columns))], handleInvalid="keep")
    ranked = ranker.transform(numbered)
    curve = F.lit(0).cast("long")
    for k in range(len(columns)):
        # a value that is many quantiles has the first one's rank, and those behind it the ranks that their rows have
        last = (1 << bits) - 1
        ranks = [0, *[quantiles[k].index(c) + 1 for c in cuts[k][1:-1]], last]
        rank = F.element_at(F.array(*map(F.lit, ranks)), F.col(f"_r{k}").cast("int") + 1).cast("long")
        for bit in range(bits):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1))
            curve = curve.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - k))
    return ranked.withColumn(name, curve).drop(*inputs, *[f"_r{k}" for k in range(len(columns))])


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int, mode: str = "overwrite") -> None:
    """Write along the curve in about ``files`` files, and beside them the bounds of each file's columns.

    Rows of one place are told apart by the task that read them, so a value that holds a large part of the table is split.
    """
    curved = with_curve(df, columns).withColumn("_task", F.spark_partition_id())
    ranged = curved.repartitionByRange(files, "_curve", "_task").sortWithinPartitions("_curve").drop("_curve", "_task")
    ranged.write.mode(mode).option("compression", "snappy").parquet(path)
    write_ranges(df.sparkSession, path, columns)


def write_ranges(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    """The least and greatest value, and the nulls, of some columns of each file: one narrow scan."""
    ends = [f(quote(c)).alias(f"{n}_{c}") for c in columns for f, n in ((F.min, "least"), (F.max, "most"))]
    nulls = [F.count_if(F.col(quote(c)).isNull()).alias(f"nulls_{c}") for c in columns]
    held = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file_path")).agg(*ends, *nulls)
    # a name that readers of the folder pass over
    held.coalesce(1).write.mode("overwrite").parquet(f"{path}/{RANGES}")


def files_within(spark: SparkSession, path: str, bounds: dict[str, tuple]) -> list[str]:
    """The files that may hold rows within all of the bounds (``column: (least, most)``, either None)."""
    keep = []
    for column, (least, most) in bounds.items():
        if least is not None:
            keep.append(F.col(quote(f"most_{column}")) >= least)
        if most is not None:
            keep.append(F.col(quote(f"least_{column}")) <= most)
    found = spark.read.parquet(f"{path}/{RANGES}").filter(reduce(Column.__and__, keep, F.lit(True)))
    # one name for each file
    return [r["file_path"] for r in found.select("file_path").collect()]


def read_clustered(spark: SparkSession, path: str, **bounds: tuple) -> DataFrame:
    """Rows within all bounds; files that cannot hold any are not opened."""
    whole = spark.read.parquet(path)
    names = files_within(spark, path, bounds)
    held = spark.read.schema(whole.schema).parquet(*names) if names else whole.limit(0)
    for column, (least, most) in bounds.items():
        if least is not None:
            held = held.filter(F.col(quote(column)) >= least)
        if most is not None:
            held = held.filter(F.col(quote(column)) <= most)
    return held
