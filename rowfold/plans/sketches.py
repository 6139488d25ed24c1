"""Distinct counts that add up: sketches of each load's values, kept with its report and united without reading rows.

HyperLogLog sketches answer how many different values there are; theta sketches also how many of a load's values were not
there before. Relative standard errors follow from their size alone (:data:`ERROR`); three of them are the bound that is stated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.functions.hashing import quote

#: Logarithm of the entries of a sketch: some 4 KB for HyperLogLog, 32 KB for theta.
LOG_SIZE = 12
#: Relative standard errors: 1.04 and 1 over the root of the entries.
ERROR = {"hll": 1.04 / 2 ** (LOG_SIZE / 2), "theta": 1.0 / 2 ** (LOG_SIZE / 2)}
SKETCH_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("hll", T.BinaryType()),
        T.StructField("theta", T.BinaryType()),
    ]
)


def sketch_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, hll, theta``: a row for each column, all from one pass; partial sketches are united by the shuffle. Nulls do not count."""
    text = {c: F.col(quote(c)).cast("string") for c in columns}
    made = []
    for k, c in enumerate(columns):
        made += [F.hll_sketch_agg(text[c], LOG_SIZE).alias(f"h{k}"), F.theta_sketch_agg(text[c], LOG_SIZE).alias(f"t{k}")]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"h{k}").alias("hll"), F.col(f"t{k}").alias("theta")) for k, c in enumerate(columns)])
    return df.agg(*made).select(F.explode(rows).alias("s")).select("s.*")


def distinct_counts(sketches: DataFrame) -> DataFrame:
    """``column, distinct, error``: how many different values all loads have together, and three standard errors of it."""
    united = sketches.groupBy("column").agg(F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("distinct"))
    return united.select("column", "distinct", (3 * F.lit(ERROR["hll"]) * F.col("distinct")).alias("error"))


def new_values(sketches: DataFrame, load: int) -> DataFrame:
    """``column, added, error``: how many different values a load brought that no load before it had."""
    earlier = sketches.filter(F.col("load") < load).groupBy("column").agg(F.theta_union_agg("theta").alias("before"))
    own = sketches.filter(F.col("load") == load).select("column", "theta")
    met = own.join(earlier, "column", "left")
    added = F.when(F.col("before").isNull(), F.theta_sketch_estimate("theta")).otherwise(
        F.theta_sketch_estimate(F.theta_difference("theta", "before"))
    )
    # the error is one of the larger set that the difference is taken from
    size = F.theta_sketch_estimate("theta") + F.coalesce(F.theta_sketch_estimate("before"), F.lit(0))
    return met.select("column", added.alias("added"), (3 * F.lit(ERROR["theta"]) * size).alias("error"))
