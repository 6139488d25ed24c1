"""Whole-row and by-key distinct, counts and partition counts.

Each of these reduces rows inside the map tasks before the shuffle, so a key that holds a large part
of the table reaches the reducers as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowfold.functions.hashing import quote


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, any of them."""
    return df.dropDuplicates(list(keys))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in the given order.

    ``row_number() = 1`` is recognised by the optimizer: every map task sends at most one row per key.
    """
    window = Window.partitionBy(*[F.col(quote(k)) for k in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def row_count(df: DataFrame, name: str = "total_records") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def partition_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("rows"))
