"""Make this package importable in the Python workers of a session that was not started with it on the path."""

from __future__ import annotations

import functools
import io
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

from rowfold.session import new_work_dir

_NAME = "rowfold-code.zip"
# Applications that have the package already.
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Put the package's source into the shared folder and on the workers' path, once for each Spark context."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    path = f"{new_work_dir(spark, 'code')}/{_NAME}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(target)
    out.write(bytearray(held.getvalue()))
    out.close()
    context.addPyFile(str(files.makeQualified(target)))
    _SHIPPED.add(context.applicationId)


def with_package(function: Callable) -> Callable:
    """A query or stage that ships the package before it runs; the session is its first argument."""

    @functools.wraps(function)
    def run(spark: SparkSession, *args, **kwargs):
        ship_package(spark)
        return function(spark, *args, **kwargs)

    return run
