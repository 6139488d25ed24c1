"""String, null and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalised(column: Column) -> Column:
    """Case-blind comparison key. ``trim`` takes spaces only; see :func:`strip` for all white space."""
    return F.lower(F.trim(column))


def strip(column: Column) -> Column:
    """Remove leading and trailing white space of every kind."""
    return F.regexp_replace(column, r"^\s+|\s+$", "")


def default_if_null(column: Column, default) -> Column:
    return F.coalesce(column, F.lit(default))


# Times keep their microseconds.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def json_text(*columns: Column | str) -> Column:
    """A JSON object of the given columns (all when none is named); nulls are written out."""
    return F.to_json(F.struct(*(columns or ("*",))), JSON_OPTIONS)


def csv_text(*columns: Column | str, **options: str) -> Column:
    return F.to_csv(F.struct(*(columns or ("*",))), options)


def parsed(column: Column, schema: T.StructType, corrupt_column: str | None = None) -> Column:
    """Parse JSON text. With ``corrupt_column`` the struct gains that field, holding unreadable input."""
    if corrupt_column is None:
        return F.from_json(column, schema)
    wide = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
    return F.from_json(column, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column})
