"""Filters. Exact equality, ranges and lists reach the Parquet scan; the case-blind form cannot,
so tables that are often filtered that way should store the normalised key as a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowfold.functions.hashing import quote
from rowfold.functions.text import normalised


def equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(quote(column)) == F.lit(value))


def equals_ignoring_case(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(normalised(F.col(quote(column))) == F.lit(value.strip(" ").lower()))


def with_normalised_key(df: DataFrame, column: str, name: str) -> DataFrame:
    """Store the comparison key once, so that later equality filters on it are pushed down."""
    return df.withColumn(name, normalised(F.col(quote(column))))


def present(df: DataFrame, column: str = "data") -> DataFrame:
    return df.filter(F.col(quote(column)).isNotNull())


def in_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Closed range."""
    return df.filter(F.col(quote(column)).between(low, high))


def in_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(quote(column)).isin(list(values)))


def from_cursor(df: DataFrame, group: str, chunk: str, start_group: int, start_chunk: int) -> DataFrame:
    """Units at or after the (group, chunk) cursor."""
    g, c = F.col(quote(group)), F.col(quote(chunk))
    return df.filter((g > start_group) | ((g == start_group) & (c >= start_chunk)))
