"""Replacing directories of a table so that a crash loses nothing.

The new content of the directories is written below ``root-pending`` first. Once it is there as a
whole, the directories are overwritten from it, and it is dropped when that is done. Whoever writes
next finishes a replacement that was staged to its end and drops one that was not. One process
writes to a table at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Writer = Callable[[DataFrame, str], None]


def _pending(root: str) -> str:
    return f"{root.rstrip('/')}-pending"


def replace(spark: SparkSession, rows: DataFrame, root: str, overwrite: Writer) -> None:
    """Replace the directories that ``rows`` fall into. ``overwrite`` writes them, and only them, anew."""
    pending = f"{_pending(root)}/{uuid.uuid4().hex}"
    rows.write.parquet(pending)
    _finish(spark, pending, rows.schema, root, overwrite)


def recover(spark: SparkSession, schema: T.StructType, root: str, overwrite: Writer) -> None:
    """Finish or drop what an earlier process left. Doing it again gives the same."""
    files, folder = _files(spark, _pending(root))
    if not files.exists(folder):
        return
    for status in files.listStatus(folder):
        pending = status.getPath().toString()
        if files.exists(_files(spark, f"{pending}/_SUCCESS")[1]):
            _finish(spark, pending, schema, root, overwrite)
        else:
            files.delete(status.getPath(), True)


def _finish(spark: SparkSession, pending: str, schema: T.StructType, root: str, overwrite: Writer) -> None:
    overwrite(spark.read.schema(schema).parquet(pending), root)
    files, path = _files(spark, pending)
    files.delete(path, True)


def _files(spark: SparkSession, path: str):
    """The file system of a path, as Spark sees it, and the path."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there
