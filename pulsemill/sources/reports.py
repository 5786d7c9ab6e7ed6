"""Text sources: wide reports, name lists and parser logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.functions.scalars import file_name, strip

_LOG_LINE = r"^\[(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\] (.*)$"


def with_line_position(text: DataFrame) -> DataFrame:
    """Name the columns of a text source: archive, block_start, row_id and line.

    ``row_id`` only orders lines inside one block of one file; across blocks ``block_start``
    does. It is never joined on.
    """
    return text.select(
        F.col("_metadata.file_path").alias("archive"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
        F.col("value").alias("line"),
    )


def read_wide_reports(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return with_line_position(reader.text(path))


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    """One metric name per line."""
    names = spark.read.text(path).select(strip(F.col("value")).alias("metric"))
    return names.filter("metric != ''")


def read_label_csv(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue file with the single column ``metric_name``."""
    schema = T.StructType([T.StructField("metric_name", T.StringType())])
    names = spark.read.schema(schema).option("header", "true").csv(path)
    return names.select(F.col("metric_name").alias("metric")).filter("metric IS NOT NULL")


def read_parser_log(spark: SparkSession, path: str, pattern: str = "*", log: Column | None = None) -> DataFrame:
    """Log lines; ``log`` is the whole path of the file.

    Of a log written in parts, ``log`` names what its parts have in common, as an expression on
    the column ``path``; the parts follow each other in name order.
    """
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    lines = with_line_position(reader.text(path)).withColumnRenamed("archive", "path")
    return lines.select(
        (F.col("path") if log is None else log).alias("log"),
        file_name(F.col("path")).alias("path"),
        "block_start",
        "row_id",
        F.try_to_timestamp(F.nullif(F.regexp_extract("line", _LOG_LINE, 1), F.lit("")), F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
        F.when(F.col("line").rlike(_LOG_LINE), F.regexp_extract("line", _LOG_LINE, 2)).alias("message"),
        "line",
    )
