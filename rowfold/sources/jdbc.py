"""JDBC source and sink. The driver jar comes with the deployment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 50_000
INSERT_ROWS = 100_000


def read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int | None = None,
    fetch_rows: int = FETCH_ROWS,
) -> dict[str, str]:
    """Options of a table read; with a partition column the table is read by parallel range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows)}
    ranged = (partition_column, lower, upper, partitions)
    if any(v is not None for v in ranged):
        if any(v is None for v in ranged):
            raise ValueError("a parallel read needs partition_column, lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None, **ranged) -> DataFrame:
    options = read_options(url, table, **ranged) | (properties or {})
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    mode: str = "append",
    batch_rows: int = INSERT_ROWS,
) -> None:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows)} | (properties or {})
    df.write.format("jdbc").options(**options).mode(mode).save()
