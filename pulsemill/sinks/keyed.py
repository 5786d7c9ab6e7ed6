"""A table with one row for each key, kept up to date by the batches of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.operators.points import last_write_wins
from pulsemill.session import scratch_path
from pulsemill.sinks.replacement import recover, replace
from pulsemill.sinks.tables import read_table


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("d", T.DateType())])


def _overwrite(rows: DataFrame, root: str) -> None:
    writer = rows.hint("rebalance", "d").write.mode("overwrite").partitionBy("d")
    writer.option("partitionOverwriteMode", "dynamic").parquet(root)


def merge_keyed(spark: SparkSession, rows: DataFrame, root: str, keys: list[str], time: str, batch_id: int) -> None:
    """Put a batch's rows in place of the rows with their keys.

    The batch's number stands beside each row and the greatest stays, so a batch that is repeated,
    or comes after a later one, changes nothing. Only the days (of the column ``time``, one of the
    keys) that the batch has rows of are read and written.
    """
    schema = _stored(rows.schema)
    recover(spark, schema, root, _overwrite)
    path = scratch_path(spark, "batch")
    rows.withColumns({"batch": F.lit(batch_id).cast("bigint"), "d": F.to_date(time)}).write.parquet(path)
    fresh = spark.read.schema(schema).parquet(path)
    # One row for each day of the batch. Days after 0001-01-01 are all days; the comparison lets Spark prune by it.
    days = F.broadcast(fresh.select("d").distinct().filter("d >= DATE'0001-01-01'"))
    stored = read_table(spark, root, schema).join(days, "d", "left_semi")
    both = stored.select(*schema.names).unionByName(fresh)
    replace(spark, last_write_wins(both, [*keys, "d"], ["batch"]).select(*schema.names), root, _overwrite)


def read_keyed(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return read_table(spark, root, _stored(schema)).select(*schema.names)
