"""Data expectations; each is one aggregation pass and returns one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowfold.functions.hashing import quote


def expect_between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Closed range. Nulls are counted apart and are no failures."""
    value = F.col(quote(column))
    outside = F.count_if(~value.between(F.lit(low), F.lit(high)))
    return df.agg(
        F.count("*").alias("evaluated"),
        F.count_if(value.isNull()).alias("nulls"),
        outside.alias("unexpected"),
    ).select(
        "evaluated",
        "nulls",
        "unexpected",
        F.round(
            F.coalesce(F.try_divide(F.col("unexpected") * 100, F.col("evaluated") - F.col("nulls")), F.lit(0.0)), 4
        ).alias("unexpected_percent"),
        (F.col("unexpected") == 0).alias("success"),
    )


def expect_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Are rows unique on ``columns``? Copies are counted in the map tasks first."""
    keyed = df.groupBy(*[F.col(quote(c)) for c in columns]).agg(F.count("*").alias("_copies"))
    return keyed.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_rows"),
    ).withColumn("success", F.col("rows") == F.col("distinct_rows"))


def approximate_distinct(df: DataFrame, columns: Sequence[str], error: float = 0.02) -> DataFrame:
    """Quick look at the number of distinct keys; one small sketch per task is shuffled."""
    fields = [F.col(quote(c)) for c in columns]
    # the hash skips nulls, so where they stand is hashed as well
    key = F.xxhash64(*fields, *[f.isNull() for f in fields])
    return df.agg(F.count("*").alias("rows"), F.approx_count_distinct(key, error).alias("distinct_rows"))
