"""Message streams: Kafka on a cluster, text files of one message per line anywhere else."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OFFSETS_PER_TRIGGER = 100_000


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    per_trigger: int | None = OFFSETS_PER_TRIGGER,
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_kafka(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Needs the public ``spark-sql-kafka`` package on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def read_text_messages(
    spark: SparkSession,
    path: str,
    files_per_trigger: int | None = None,
    since: str | None = None,
) -> DataFrame:
    """Stream of lines as binary ``value``, like a message topic.

    ``since`` keeps only files modified at or after that time, as a topic read from its latest offset.
    """
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    lines = reader.load(path)
    if since is not None:
        lines = lines.filter(F.col("_metadata.file_modification_time") >= F.lit(since).cast("timestamp"))
    return lines.select(F.col("value").cast("binary").alias("value"))
