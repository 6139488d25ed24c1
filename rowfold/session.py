"""Session and shared-folder helpers."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # Methods above 8000 bytes of bytecode are never compiled by the JVM; wide projections run several
    # times faster split into small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Do not record a stack trace for every column expression built from Python.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # State of streams that outgrows memory, with timers.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Remove checkpoint files of plans that are no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "rowfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; keyword ``a__b`` becomes conf ``a.b``.

    Memory, executors and timeouts are left to the deployment. Broadcast threshold, skew handling
    and partition coalescing keep Spark's adaptive defaults.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    A session that runs in one process and has no such setting works beside its warehouse. On a cluster the
    setting is required, and a path without a scheme means the cluster's default file system.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    context = spark.sparkContext
    if not configured:
        configured = context.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.exists(folder)


def create_new(spark: SparkSession, path: str, content: str) -> None:
    """Write a small file that must not exist yet."""
    target, files = _folder(spark, path)
    out = files.create(target, False)
    out.write(bytearray(content.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, such as one of :func:`create_new`."""
    return "".join(r["value"] for r in spark.read.option("wholetext", True).text(path).collect())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    folder, files = _folder(spark, path)
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def make_dir(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.mkdirs(folder)


def remove_work_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`new_work_dir`."""
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def stage(df: DataFrame, work_dir: str, name: str, **options: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Computed once, it stays as it is when executors are lost, and later steps read only the columns
    they need. ``options`` go to the writer.
    """
    path = f"{work_dir}/{name}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` on reliable shared storage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
