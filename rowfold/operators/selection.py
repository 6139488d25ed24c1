"""Rows by rank without a sort: histograms of the order key, refined round by round."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.functions.hashing import quote

# Bins of a round; a round is one pass over one column, and returns two numbers for each bin.
BINS = 4_096
_NUMBERS = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Cut:
    """Rows whose key is at most ``key`` (as a number), nulls included, are ``rows`` in all."""

    key: float
    rows: int


def can_rank(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, _NUMBERS)


def _number(df: DataFrame, column: str) -> Column:
    value, kind = F.col(quote(column)), df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return value.cast("double")


def cut_at_rank(df: DataFrame, column: str, rank: int, slack: float = 0.05, most_rounds: int = 12) -> Cut | None:
    """A key up to which there are ``rank`` rows or a few more; None if there are not so many rows.

    Nulls come first. The bin that the rank falls into is cut into bins anew until what lies in it is ``slack`` of the rank, or one
    value. Nothing is sorted and no row leaves its task but as a count.
    """
    numbered = df.select(_number(df, column).alias("n"))
    ends = numbered.agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("rows"), F.count_if(F.col("n").isNull()).alias("nulls")).first()
    if ends["rows"] < rank or ends["low"] is None:
        return None
    low, high, before = ends["low"], ends["high"], ends["nulls"]
    if before >= rank:
        return Cut(float("-inf"), before)
    for _ in range(most_rounds):
        width = (high - low) / BINS
        if width <= 0:
            break
        inside = numbered.filter((F.col("n") >= low) & (F.col("n") <= high))
        place = F.least(F.floor((F.col("n") - low) / width), F.lit(BINS - 1)).cast("int")
        # bins are told by the greatest key in them, so that no rounding moves a row over a cut
        bins = sorted(inside.groupBy(place.alias("bin")).agg(F.count("*").alias("rows"), F.min("n").alias("low"), F.max("n").alias("high")).collect())
        for found in bins:
            if before + found["rows"] >= rank:
                break
            before += found["rows"]
        if before + found["rows"] <= rank * (1 + slack) or found["low"] == found["high"]:
            return Cut(found["high"], before + found["rows"])
        low, high = found["low"], found["high"]
    return Cut(high, before + numbered.filter((F.col("n") >= low) & (F.col("n") <= high)).count())


def up_to(df: DataFrame, column: str, cut: Cut) -> DataFrame:
    """The rows before a cut, nulls included."""
    return df.filter(F.col(quote(column)).isNull() | (_number(df, column) <= cut.key))
