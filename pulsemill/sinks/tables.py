"""Parquet and text sinks: raw reports, names, ledger and point export."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.functions.scalars import file_name
from pulsemill.operators.joins import new_metrics
from pulsemill.session import scratch_path

CATALOG = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("first_seq", T.LongType()),
        T.StructField("first_archive", T.StringType()),
        T.StructField("first_pos", T.IntegerType()),
    ]
)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, empty if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_bronze(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Keep the raw lines with their place in their report."""
    lines.write.mode(mode).parquet(path)


def export_reports(bronze: DataFrame, path: str) -> None:
    """Write kept lines back as text, one folder per report. A long report becomes several
    files whose names sort in line order."""
    ordered = bronze.repartitionByRange("archive", "block_start", "row_id")
    ordered = ordered.sortWithinPartitions("archive", "block_start", "row_id")
    ordered.select(file_name(F.col("archive")).alias("report"), "line").write.partitionBy("report").text(path)


def write_validated(metrics: DataFrame, path: str) -> None:
    """Replace the validated list, one name per line."""
    metrics.select("metric").distinct().write.mode("overwrite").text(path)


def append_catalog(spark: SparkSession, seen: DataFrame, path: str) -> None:
    """Add the names the catalogue does not have yet."""
    fresh = new_metrics(seen, read_table(spark, path, CATALOG))
    staged = scratch_path(spark, "catalog")
    fresh.select(*CATALOG.names).write.parquet(staged)
    spark.read.schema(CATALOG).parquet(staged).write.mode("append").parquet(path)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, CATALOG)


def append_ledger(ledger: DataFrame, path: str) -> None:
    """Add a run's rows; a repeated run replaces its own."""
    writer = ledger.write.mode("overwrite").partitionBy("ingest_seq")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def write_line_protocol(lines: DataFrame, path: str) -> None:
    """Export files for an outside time-series store."""
    lines.select("line").write.mode("overwrite").text(path)
