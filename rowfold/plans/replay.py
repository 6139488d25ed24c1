"""Publish a table as JSON messages and read it back, as a stream or as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowfold.sinks.messages import as_messages, publish_files
from rowfold.sources.messages import read_text_messages
from rowfold.streaming.messages import parse_messages


def round_trip(df: DataFrame) -> DataFrame:
    """Every row through its JSON form and back, in one job."""
    binary = as_messages(df).select(F.col("value").cast("binary").alias("value"))
    return parse_messages(binary, df.schema)


def replay(df: DataFrame, path: str, num_files: int | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """Write the table's messages under ``path`` and return the stream that reads them."""
    publish_files(df, path, "overwrite", num_files)
    return parse_messages(read_text_messages(df.sparkSession, path, files_per_trigger), df.schema)
