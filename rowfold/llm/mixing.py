"""Mixing sources to target weights, constant or changing over the run.

*Targets.* Each source has a weight, or a schedule of weights over the run (points ``(time, weight)`` with times from 0 to 1,
linear in between). The integral of its weight is its demand; the sources share the whole budget by demand. No source takes
more than ``most_epochs`` times its size: what is too much is shared again by demand among the others, until none is above.

*Positions.* The documents of a source are lined up in a seeded order that does not depend on the run, epoch after epoch,
until the target is full; the last one is taken up to the target. A document's place in its line is cumulative demand:
inverting the source's demand over the run gives the time at which it is due, its training position. All documents, sorted
by position over the ranges of the cluster, are the curriculum (:func:`scheduled` writes it). A document's words taken are
those of its uses there.

Sizes are summed along the lines in two steps: inside slices of the seeded order, and over the slices' totals, so that no
source, however large, is in one task. Equal rows are counted, and expanded after the sums.

A null or empty text has size 0: it takes no words and is not placed. A null source is a source of its own, named last.
Rows with equal id, source and size are interchangeable. If all sources are empty, all targets are 0.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.llm.flat import FlatTexts, map_texts
from rowfold.session import new_work_dir, stage

Schedule = Sequence[tuple[float, float]]
#: Schedules that sources take in turn; over the run they weigh 1, 2 and 3: one rises, one rises and falls, one falls.
CYCLE: tuple[Schedule, ...] = (((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (0.5, 3.0), (1.0, 1.0)), ((0.0, 4.5), (1.0, 1.5)))
MOST_EPOCHS = 3
# Rows of a source's line that are summed together, about.
SLICE_ROWS = 4_000
SEED = "mix"


def sized(docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id", "source")) -> DataFrame:
    """The number of words of every text as ``size``."""

    def work(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        return {"size": FlatTexts.of(batch.column("text")).word_counts()}

    return map_texts(docs, work, T.StructType([T.StructField("size", T.LongType())]), text=text_col, keep=keep)


def demand(schedule: Schedule) -> float:
    """The integral of a schedule over the run."""
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False))


def due(share: Column, schedule: Schedule) -> Column:
    """The time at which a source has met ``share`` (0 to 1) of its demand: the inverse of the demand's integral."""
    whole, past, out = demand(schedule), 0.0, F.lit(1.0)
    steps = []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        area, slope = (t1 - t0) * (w0 + w1) / 2, (w1 - w0) / (t1 - t0) if t1 > t0 else 0.0
        if area <= 0:
            continue
        need = F.greatest(share * F.lit(whole) - F.lit(past), F.lit(0.0))
        if slope:
            # w0 * x + slope * x * x / 2 = need
            x = (F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * need, F.lit(0.0))) - w0) / slope
        else:
            x = need / w0
        past += area
        steps.append((past / whole, F.least(F.lit(t0) + x, F.lit(t1))))
    for end, at in reversed(steps):
        out = F.when(share <= F.lit(end), at).otherwise(out)
    return out


def source_targets(totals: DataFrame, cycle: Sequence[Schedule] = CYCLE, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``source, kind, source_size, target`` from ``source, source_size``; one row per source throughout.

    Sources by code point, null last, take the schedules of ``cycle`` in turn (``kind``). Those that reach their limit are the
    ones with the least limit per demand, so a running sum in that order finds the level at which the rest share.
    """
    kind = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(cycle))).cast("int")
    numbered = totals.withColumn("kind", kind)
    weight = F.element_at(F.array(*[F.lit(float(demand(s))) for s in cycle]), F.col("kind") + 1)
    weighed = numbered.withColumn("weight", weight).withColumn("limit", F.lit(most_epochs) * F.col("source_size"))
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything)
    left_budget = budget - F.coalesce(F.sum("limit").over(before), F.lit(0))
    left_weight = F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = weighed.withColumn("level", left_budget / left_weight)
    # the first source, by level, that does not reach its limit sets the level for all behind it
    settles = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))
    rank = F.row_number().over(by_level)
    ranked = levels.withColumn("rank", rank).withColumn("settles", settles)
    level = F.min(F.when(F.col("settles").isNotNull(), F.struct("rank", "settles"))).over(everything)
    final = ranked.withColumn("final", level["settles"])
    share = F.coalesce(F.col("final") * F.col("weight"), F.col("limit").cast("double"))
    target = F.when(F.col("rank") < level["rank"], F.col("limit").cast("double")).otherwise(share)
    return final.select("source", "kind", "source_size", target.alias("target"))


def _key() -> Column:
    """The seeded order: the same for every run and any partitioning."""
    return F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("id").cast("string"), F.lit(""))))


def line_up(sizes: DataFrame, slices: int) -> DataFrame:
    """Add ``before``: the words of the source's line that come before each row. Columns ``id, source, size``."""
    counted = sizes.groupBy("id", "source", "size").agg(F.count("*").alias("copies")).withColumn("key", _key())
    number = F.conv(F.substring("key", 1, 7), 16, 10).cast("long")
    counted = counted.withColumn("slice", F.floor(number * slices / (1 << 28)).cast("int"))
    words = F.col("size") * F.col("copies")
    known = F.col("source").isNull()
    grouped = counted.withColumn("no_source", known).withColumn("words", words).withColumn("source", F.coalesce("source", F.lit("")))
    place = ["source", "no_source", "slice"]
    totals = grouped.groupBy(*place).agg(F.sum("words").alias("total"))
    earlier = Window.partitionBy("source", "no_source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*place, F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    order = Window.partitionBy(*place).orderBy("key", F.col("id").asc_nulls_first(), "size")
    inside = grouped.withColumn("inside", F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    met = inside.join(bases, place)
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    named = F.when(F.col("no_source"), F.lit(None).cast("string")).otherwise(F.col("source"))
    return met.select("id", named.alias("source"), "size", "base", "inside", copy).select(
        "id", "source", "size", (F.col("base") + F.col("inside") + F.col("copy") * F.col("size")).alias("before")
    )


def mixture(
    docs: DataFrame,
    cycle: Sequence[Schedule] = CYCLE,
    most_epochs: int = MOST_EPOCHS,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    work_dir: str | None = None,
) -> DataFrame:
    """``id, size, source, source_size, target, kind, before`` of every row."""
    work_dir = work_dir or new_work_dir(docs.sparkSession, "mixture")
    sizes = sized(docs, text_col, (id_col, source_col)).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), "size"
    )
    sizes = stage(sizes, work_dir, "sizes")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = stage(source_targets(totals.drop("rows"), cycle, most_epochs), work_dir, "targets")
    rows = sizes.count()
    lined = line_up(sizes, max(1, rows // SLICE_ROWS))
    met = lined.join(targets, lined["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    return met.select(F.col("id").alias(id_col), "size", "source", "source_size", "target", "kind", "before")


def scheduled(mixed: DataFrame, work_dir: str, cycle: Sequence[Schedule] = CYCLE, most_epochs: int = MOST_EPOCHS) -> tuple[DataFrame, DataFrame]:
    """The curriculum, range-sorted by position and written, and the rows of ``mixed`` with the words ``taken`` in it.

    Uses with one position are in the order of epochs and rows; rows are numbered as they are written first.
    """
    rows = stage(mixed.withColumn("row", F.monotonically_increasing_id()), work_dir, "mixed")
    placed = curriculum(rows, cycle, most_epochs)
    order = ["position", "epoch", "row"]
    placed = stage(placed.repartitionByRange(*order).sortWithinPartitions(*order), work_dir, "curriculum")
    taken = placed.groupBy("row").agg(F.sum("words").alias("taken"), F.min("position").alias("first_position"))
    told = rows.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
    return placed, told.drop("row")


def curriculum(mixed: DataFrame, cycle: Sequence[Schedule] = CYCLE, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """One row for each time a document is used: ``epoch, words`` taken then, and ``position`` (0 to 1), with its columns.

    ``words`` is the document's size but for the one that fills up its source's target.
    """
    used = mixed.select("*", F.explode(F.sequence(F.lit(0), F.lit(most_epochs - 1))).alias("epoch"))
    at = F.col("epoch") * F.col("source_size") + F.col("before")
    words = F.least(F.col("size"), F.round("target").cast("long") - at)
    used = used.withColumn("words", words).filter("words > 0")
    share = at / F.col("target")
    position = F.lit(None).cast("double")
    for kind, schedule in enumerate(cycle):
        position = F.when(F.col("kind") == kind, due(share, schedule)).otherwise(position)
    return used.withColumn("position", position)
