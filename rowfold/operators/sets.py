"""Limits, slices, unions, sampling, duplicate injection and repartitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowfold.functions.hashing import quote
from rowfold.functions.seeded import MODULUS, wide_mix
from rowfold.operators.positions import row_positions
from rowfold.session import cut_lineage


def limit(df: DataFrame, n: int, order: Sequence[str | Column] | None = None) -> DataFrame:
    """First ``n`` rows, in order; give a total order for a result that repeats.

    Every task sends its own first ``n`` to one, so this is for reports; :func:`first_rows` is for many.
    """
    return df.limit(n) if order is None else df.orderBy(*order).limit(n)


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows as a set, for any ``n``: rows are numbered in parallel and none is sent to one task."""
    return row_positions(df, order, name="_position").filter(F.col("_position") < n).drop("_position")


def slice_rows(df: DataFrame, chunk: int, column: str = "chunk") -> DataFrame:
    return df.filter(F.col(column) == chunk)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    if not frames:
        raise ValueError("union_all needs at least one DataFrame")
    return reduce(lambda left, right: left.unionByName(right), frames)


# Numbers of a draw: those of :func:`rowfold.functions.seeded.wide_mix`.
_DRAWS = MODULUS * MODULUS


def poisson_steps(mean: float) -> list[int]:
    """Draws below the k-th of these numbers come k times or fewer: the distribution function, scaled to the draws."""
    steps, share, total, k = [], math.exp(-mean), 0.0, 0
    while total + share < 1 - 1e-13 and k < 1_000:
        total += share
        steps.append(int(total * _DRAWS))
        k += 1
        share *= mean / k
    return steps


def sample_with_replacement(df: DataFrame, fraction: float, salt: int = 1, row_id: Column | None = None) -> DataFrame:
    """Each row as often as a Poisson draw of mean ``fraction`` says, which is made from its id by inversion.

    The sample depends on the ids and the salt and on nothing else: not on partitioning, nor on what other rows there are. ``row_id``
    is a whole number, not negative and under 1.9e14; by default a hash of all columns. Rows with one id come equally often.
    For a sample of an exact size see :func:`duplicates`.
    """
    if not 0 < fraction <= 100:
        raise ValueError("a mean of more than 0 and 100 at most")
    nulls = F.concat(*[F.col(quote(c)).isNull().cast("string") for c in df.columns])
    row_id = F.pmod(F.xxhash64(nulls, *[F.col(quote(c)) for c in df.columns]), F.lit(1 << 47)) if row_id is None else row_id
    drawn = df.withColumn("_draw", wide_mix(row_id, salt))
    # most rows are not drawn, and the first step tells
    steps = poisson_steps(fraction)
    some = drawn.filter(F.col("_draw") >= steps[0])
    times = reduce(lambda x, y: x + y, [(F.col("_draw") >= s).cast("int") for s in steps])
    return some.withColumn("_use", F.explode(F.sequence(F.lit(1), times))).drop("_draw", "_use")


def duplicates(df: DataFrame, order: Sequence[str], count: int, salt: int = 1) -> DataFrame:
    """Exactly ``count`` repeats of rows of ``df``, drawn with replacement by row position.

    Only the order columns are sorted and numbered. Draws are counted per position before they meet them, so a row that
    is drawn often costs one join row, and each row is repeated where it lies. ``order`` must be a total order of the rows.
    """
    numbered = row_positions(df.select(*[F.col(quote(c)) for c in order]), order, name="_position")
    size = numbered.count()
    if size == 0 or count == 0:
        return df.limit(0)
    draws = (
        df.sparkSession.range(count)
        .select((wide_mix(F.col("id"), salt) % F.lit(size)).alias("_position"))
        .groupBy("_position")
        .agg(F.count("*").alias("_copies"))
    )
    drawn = numbered.join(draws, "_position").select(*[F.col(quote(c)).alias(f"_{k}") for k, c in enumerate(order)], "_copies")
    same = reduce(lambda x, y: x & y, [F.col(quote(c)).eqNullSafe(F.col(f"_{k}")) for k, c in enumerate(order)])
    return (
        df.join(drawn, same)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
        .select(*[F.col(quote(c)) for c in df.columns])
    )


def inject_duplicates(df: DataFrame, order: Sequence[str], count: int, salt: int = 1) -> DataFrame:
    """``df`` plus exactly ``count`` repeated rows."""
    return df.unionByName(duplicates(df, order, count, salt))


def materialise(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage, on reliable shared storage."""
    return cut_lineage(df)
