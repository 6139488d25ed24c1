"""Membership, upsert and dimension look-up.

No side is broadcast by hint here: Spark broadcasts a side only while its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles. A hot key of a shuffled side is split by Spark's adaptive
handling of skewed joins alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowfold.functions.hashing import quote


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def already_seen(batch: DataFrame, seen: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is stored."""
    return batch.join(seen, _keys(key), "left_semi")


def not_seen(batch: DataFrame, seen: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not stored; rows with a null key are kept."""
    return batch.join(seen, _keys(key), "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``old`` with the rows of ``new`` put in place of, or next to, those with the same key."""
    return old.join(new, _keys(key), "left_anti").unionByName(new)


def lookup_row(table: DataFrame, key: str, value, default: dict) -> DataFrame:
    """The row stored under a key, or one row of defaults when there is none; a key stored twice is an error.

    An aggregate without groups gives one row whatever it finds, so no join is planned.
    """
    row = F.struct(*[F.col(quote(c)) for c in table.columns])
    found = table.filter(F.col(quote(key)) == F.lit(value)).agg(F.first(row).alias("_row"), F.count("*").alias("_n"))
    found = found.withColumn("_row", F.when(F.col("_n") > 1, F.raise_error(F.lit(f"{key} is stored twice"))).otherwise(F.col("_row")))
    columns = []
    for field in table.schema.fields:
        stored = F.col("_row")[field.name]
        missing = value if field.name == key else default.get(field.name)
        if field.name in default:
            missing = default[field.name]
        fallback = F.lit(missing).cast(field.dataType)
        columns.append(F.when(F.col("_n") == 0, fallback).otherwise(stored).alias(field.name))
    return found.select(*columns)


def lookup_dimension(facts: DataFrame, dimension: DataFrame, key: str, how: str = "inner") -> DataFrame:
    return facts.join(dimension, key, how)
