"""Publishing rows as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rowfold.functions.text import json_text

# Producer batching of the published system.
LINGER_MS = 500
BATCH_BYTES = 32_768


def as_messages(df: DataFrame) -> DataFrame:
    """One text column ``value`` holding the whole row as JSON, nulls included."""
    return df.select(json_text().alias("value"))


def kafka_write_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.linger.ms": str(LINGER_MS),
        "kafka.batch.size": str(BATCH_BYTES),
    }


def _counted(messages: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows while they are written: in the writing tasks, which Spark counts once each."""
    published = Observation()
    return messages.observe(published, F.count(F.lit(1)).alias("rows")), published


def publish_kafka(df: DataFrame, servers: str, topic: str) -> int:
    """Publish every row and return how many there were; needs the public ``spark-sql-kafka`` package."""
    messages, published = _counted(as_messages(df))
    messages.write.format("kafka").options(**kafka_write_options(servers, topic)).save()
    return published.get["rows"]


def publish_files(df: DataFrame, path: str, mode: str = "append", num_files: int | None = None) -> int:
    """Text files of one message per line, which a file stream can follow; returns the row count."""
    if num_files is not None:
        df = df.repartition(num_files)
    messages, published = _counted(as_messages(df))
    messages.write.mode(mode).text(path)
    return published.get["rows"]
