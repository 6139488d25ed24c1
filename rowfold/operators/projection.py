"""Projections: casts, struct flattening, renames and schema conformance."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.functions.hashing import field_text, quote
from rowfold.functions.text import parsed


def binary_to_text(df: DataFrame, column: str = "value", name: str = "json_str") -> DataFrame:
    return df.select(F.col(quote(column)).cast("string").alias(name))


def parse_json(
    df: DataFrame,
    schema: T.StructType,
    column: str = "json_str",
    name: str = "data",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Add the parsed struct. Give only the fields that are needed: the parser reads no others."""
    return df.withColumn(name, parsed(F.col(quote(column)), schema, corrupt_column))


def flatten(df: DataFrame, column: str = "data") -> DataFrame:
    return df.select(f"{quote(column)}.*")


def as_text(df: DataFrame, columns: Sequence[str] | None = None, null_text: str | None = None) -> DataFrame:
    """Named columns (all by default) as text; nulls stay null unless ``null_text`` is given."""
    chosen = set(columns or df.columns)
    out = []
    for field in df.schema.fields:
        value = F.col(quote(field.name))
        if field.name in chosen:
            value = field_text(field.name, field.dataType)
            if null_text is not None:
                value = F.coalesce(value, F.lit(null_text))
        out.append(value.alias(field.name))
    return df.select(*out)


def with_record(df: DataFrame, name: str = "record", columns: Sequence[str] | None = None) -> DataFrame:
    """Add the row itself as one named struct."""
    return df.withColumn(name, F.struct(*[F.col(quote(c)) for c in columns or df.columns]))


def snake_name(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def snake_case(df: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Rename display names to snake case; ``overrides`` holds the names that follow no rule."""
    overrides = overrides or {}
    names = [overrides.get(c, snake_name(c)) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"names collide after renaming: {names}")
    return df.toDF(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to exactly the fields of ``schema``."""
    return df.select(*[F.col(quote(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])
