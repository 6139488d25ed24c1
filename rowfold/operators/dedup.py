"""Duplicate accounting of a batch against everything loaded before.

Everything here works on narrow rows (hash, position) that are counted inside the map tasks
before they are shuffled, so no step ever holds all copies of one record in one place.

A record of a few numbers is narrower than its hash and stands for it (``keys``): its hash is computed where stored hashes
are compared or written, and is neither shuffled nor staged before.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowfold.functions.hashing import RECORD_HASH, narrow_columns, record_hash, row_text
from rowfold.operators.joins import already_seen, not_seen
from rowfold.operators.positions import chunk_of, index_of, row_group_of, row_positions, running_totals
from rowfold.session import new_work_dir, stage

# A second, independent hash of the row: two different rows with one record hash differ in it.
CHECK = "check_hash"


# Names that the steps here and those of stored hashes give to columns of their own.
_OWN_NAMES = {RECORD_HASH, CHECK, "position", "row_group", "chunk", "copies", "shared", "is_first", "bucket", "run", "runs", "bits", "offsets", "marks"}


def row_keys(df: DataFrame, columns: Sequence[str], algorithm: str = "sha256", order: Sequence[str] | None = None) -> list[str]:
    """The columns of a record that stand for its hash; none if they cannot.

    With ``order`` they have to be among the order columns, so that rows with equal order values are equal records.
    """
    plain = all(re.fullmatch(r"[A-Za-z]\w*", c) and c.lower() not in _OWN_NAMES for c in columns)
    inside = order is None or set(columns) <= set(order)
    return narrow_columns(df, columns, algorithm) if plain and inside else []


def hashed_rows(placed: DataFrame, columns: Sequence[str], algorithm: str = "sha256") -> DataFrame:
    """``record_hash, check_hash, position`` of rows that carry their position, with the record's columns if they stand for the hash."""
    return placed.select(*_hashes(placed, columns, algorithm), *row_keys(placed, columns, algorithm), "position")


def _hashes(df: DataFrame, columns: Sequence[str], algorithm: str) -> list[Column]:
    digest = record_hash(df, columns, algorithm, as_hex=False).alias(RECORD_HASH)
    return [digest, F.hash(row_text(df, columns)).alias(CHECK)]


def ordered_rows(
    df: DataFrame,
    order: Sequence[str],
    columns: Sequence[str],
    algorithm: str = "sha256",
    work_dir: str | None = None,
) -> DataFrame:
    """``record_hash, check_hash, position`` of a table whose arrival order is given by columns, as :func:`hashed_rows` gives them.

    Only the order columns and the hash are sorted, never the records. They are written down first,
    because drawing the ranges takes a pass of its own: the table is read and hashed once. Different
    records with equal order values are ordered by hash. Records that are narrower than their hash and part of the order are
    sorted without it.
    """
    work_dir = work_dir or new_work_dir(df.sparkSession, "ordered")
    keys = row_keys(df, columns, algorithm, order)
    if keys:
        placed = row_positions(df.select(*order), order, work_dir=work_dir, keep=keys)
        return hashed_rows(placed, keys, algorithm)
    narrow = stage(df.select(*order, *_hashes(df, columns, algorithm)), work_dir, "hashed")
    placed = row_positions(narrow, [*order, RECORD_HASH], work_dir=work_dir, keep=[RECORD_HASH, CHECK])
    return placed.select(RECORD_HASH, CHECK, "position")


def chunk_groups(rows: DataFrame, chunk_size: int, keys: Sequence[str] = ()) -> DataFrame:
    """Copies and first position of each record hash in each chunk, and whether different rows share it.

    With ``keys`` records are told apart by these columns instead, and no two of them are taken for one.
    """
    shared = F.lit(False) if keys else F.min(CHECK) != F.max(CHECK)
    return (
        rows.groupBy(
            *(keys or [RECORD_HASH]),
            row_group_of(F.col("position")).alias("row_group"),
            chunk_of(F.col("position"), chunk_size).alias("chunk"),
        )
        .agg(
            F.count("*").alias("copies"),
            F.min("position").alias("position"),
            shared.cast("bigint").alias("shared"),
        )
    )


def with_first(groups: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mark the first group of each record; a record has one group in a chunk at most."""
    keys = list(keys or [RECORD_HASH])
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("position"))
    return groups.select(*keys, "position", "copies", "shared").withColumn("is_first", number == 1)


def new_records(groups: DataFrame, seen: DataFrame | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``record_hash, position`` of the first copy of each record that is not stored yet.

    ``seen`` are the stored hashes, each once, or what keeps the rows whose hash is not stored. The batch has one row per
    hash by then and is the side that is held in memory, part by part: stored hashes that it has are looked up in it.
    """
    return unseen(groups.groupBy(RECORD_HASH).agg(F.min("position").alias("position")), seen)


def unseen(firsts: DataFrame, seen: DataFrame | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Of rows with a hash each, those whose hash is not stored; see :func:`new_records`."""
    if callable(seen):
        return seen(firsts)
    known = already_seen(seen.select(RECORD_HASH), firsts.select(RECORD_HASH).hint("shuffle_hash"), RECORD_HASH)
    return not_seen(firsts, known.hint("shuffle_hash"), RECORD_HASH)


def chunk_report(groups: DataFrame, new: DataFrame, chunk_size: int) -> DataFrame:
    """Per chunk: rows, duplicates inside it, different rows with one hash, records stored before, new records.

    ``hash_dedup`` counts a hash of several different rows once in each chunk: one row more is lost to it.
    """
    zero = F.lit(0).cast("bigint")
    counted = groups.select(
        row_group_of(F.col("position")).alias("row_group"),
        chunk_of(F.col("position"), chunk_size).alias("chunk"),
        "copies",
        "shared",
        F.lit(1).alias("_record"),
        zero.alias("_new"),
    )
    fresh = new.select(
        row_group_of(F.col("position")).alias("row_group"),
        chunk_of(F.col("position"), chunk_size).alias("chunk"),
        zero.alias("copies"),
        zero.alias("shared"),
        zero.alias("_record"),
        F.lit(1).alias("_new"),
    )
    # both are counted per chunk in their map tasks and meet in one shuffle of those counts
    chunks = (
        counted.unionByName(fresh)
        .groupBy("row_group", "chunk")
        .agg(
            F.sum("copies").alias("rows"),
            F.sum("shared").alias("hash_dedup"),
            F.sum("_record").alias("_records"),
            F.sum("_new").alias("new"),
        )
    )
    return chunks.select(
        "row_group",
        "chunk",
        "rows",
        (F.col("rows") - F.col("_records") - F.col("hash_dedup")).alias("in_chunk"),
        "hash_dedup",
        (F.col("_records") - F.col("new")).alias("already"),
        "new",
    )


def with_progress(report: DataFrame) -> DataFrame:
    """Add the running totals a cap or a step limit is checked against."""
    counted = report.withColumn(
        "duplicates", F.col("in_chunk") + F.col("hash_dedup") + F.col("already")
    ).withColumn("steps", F.lit(1).cast("bigint"))
    return running_totals(counted, ["new", "duplicates", "steps"]).drop("steps")


def at_or_before(row_group: int, chunk: int):
    """Condition on (row_group, chunk)."""
    return (F.col("row_group") < row_group) | ((F.col("row_group") == row_group) & (F.col("chunk") <= chunk))


def last_position_kept(new: DataFrame, row_group: int, chunk: int, chunk_size: int, keep: int) -> int:
    """Position of the ``keep``-th new record of one chunk; ranks at most a chunk of narrow rows."""
    inside = new.filter(
        (row_group_of(F.col("position")) == row_group)
        & (index_of(F.col("position")) >= chunk * chunk_size)
        & (index_of(F.col("position")) < (chunk + 1) * chunk_size)
    )
    kept = inside.select("position").orderBy("position").limit(keep)
    return kept.agg(F.max("position")).first()[0]
