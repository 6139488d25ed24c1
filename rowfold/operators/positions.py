"""Row positions and running totals without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowfold.session import new_work_dir, stage

# A position is ``row_group * ROW_GROUP_SPAN + index of the row in its group``: one bigint that sorts
# like the pair. Room for 2^40 rows in a group and 2^23 groups.
ROW_GROUP_SPAN = 1 << 40
# Numbers that ascend are stored as differences.
ASCENDING = {"parquet.writer.version": "v2"}
# Rows of a range, about.
RANGE_ROWS = 2_000_000


def row_group_of(position: Column) -> Column:
    return F.shiftright(position, 40)


def index_of(position: Column) -> Column:
    return position.bitwiseAND(F.lit(ROW_GROUP_SPAN - 1))


def chunk_of(position: Column, chunk_size: int) -> Column:
    return F.call_function("div", index_of(position), F.lit(chunk_size))


def row_positions(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "position",
    partitions: int | None = None,
    work_dir: str | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given order.

    The rows are range-partitioned and sorted once and written down with their place in their range
    (range bounds come from a sample, so they must not be drawn again). All that crosses ranges is one
    row count for each. Rows that tie are told apart by the task that read them, so that many copies of
    one row are spread over several ranges. ``keep`` names the columns that are written down, all by default.
    """
    spark = df.sparkSession
    # by the number of rows: a range is sorted by one task
    shards = partitions or max(spark.sparkContext.defaultParallelism, -(-df.count() // RANGE_ROWS))
    tied = df.withColumn("_task", F.spark_partition_id())
    ranged = tied.repartitionByRange(shards, *order, "_task").sortWithinPartitions(*order, "_task").drop("_task")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ranged.select(*(["*"] if keep is None else keep), F.spark_partition_id().alias("_shard"), place.alias("_place"))
    placed = stage(numbered, work_dir or new_work_dir(spark, "positions"), "rows", **ASCENDING)

    totals = placed.groupBy("_shard").agg(F.count("*").alias("_total"))
    before = Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    # at most ``shards`` rows
    offsets = totals.select("_shard", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_shard")
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_shard", "_offset", "_place")
    )


def with_chunk(df: DataFrame, order: Sequence[str], chunk_size: int, name: str = "chunk") -> DataFrame:
    """Number of the fixed-size slice each row falls into, in the given total order."""
    numbered = row_positions(df, order, name="_position")
    return numbered.withColumn(name, F.call_function("div", F.col("_position"), F.lit(chunk_size))).drop("_position")


def running_totals(
    report: DataFrame,
    columns: Sequence[str],
    group: str = "row_group",
    step: str = "chunk",
    prefix: str = "total_",
    block: int = 1024,
) -> DataFrame:
    """Add running totals of ``columns`` in (group, step) order.

    Sums run inside blocks of ``block`` steps, and blocks are chained by their totals, so the one
    unpartitioned window sees a row per block, never a row per step.
    """
    blocked = report.withColumn("_block", F.call_function("div", F.col(step), F.lit(block)))
    totals = blocked.groupBy(group, "_block").agg(*[F.sum(c).alias(f"_sum_{c}") for c in columns])
    earlier = Window.orderBy(group, "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        group,
        "_block",
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in columns],
    )
    within = Window.partitionBy(group, "_block").orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    running = blocked.select("*", *[F.sum(c).over(within).alias(f"_run_{c}") for c in columns])
    # a left join adds no null filter, so both sides share the shuffle of the report
    return running.join(offsets, [group, "_block"], "left").select(
        *report.columns,
        *[(F.col(f"_before_{c}") + F.col(f"_run_{c}")).alias(f"{prefix}{c}") for c in columns],
    )
