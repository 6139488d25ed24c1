"""Literal maps and arrays as look-up tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_array(values: Sequence[str]) -> Column:
    """An array constant, sent to the JVM as one text and folded by the optimizer."""
    if any("\n" in v for v in values):
        return F.array(*[F.lit(v) for v in values])
    return F.split(F.lit("\n".join(values)), "\n")


def literal_map(table: Mapping[str, Sequence[str]]) -> Column:
    entries = []
    for key, values in table.items():
        entries += [F.lit(key), literal_array(values)]
    return F.create_map(*entries)


def lookup(table: Mapping[str, Sequence[str]], key: Column, default: Sequence[str]) -> Column:
    """Array stored under ``key``, or the default array."""
    return F.coalesce(F.try_element_at(literal_map(table), key), literal_array(default))


def cyclic_pick(values: Column, index: Column) -> Column:
    """``values[index mod size]`` for a non-negative 0-based index."""
    return F.element_at(values, (index % F.size(values) + 1).cast("int"))
