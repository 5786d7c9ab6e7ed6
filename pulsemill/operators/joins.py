"""Lookup and membership joins against side tables whose size is measured first."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A hash relation takes several times the plain size, so this stays far below executor memory.
BROADCAST_LIMIT = 128 * 1024 * 1024


class Side(NamedTuple):
    """A staged side table and its plain size."""

    table: DataFrame
    size: int


def _plain_bytes(df: DataFrame) -> Column:
    """Plain size of a row: text lengths, 8 bytes per array element and 16 per value."""
    per_row = F.lit(16 * len(df.columns))
    for f in df.schema.fields:
        column, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("string", "binary"):
            per_row = per_row + F.coalesce(F.octet_length(column), F.lit(0))
        elif kind == "array":
            per_row = per_row + 8 * F.coalesce(F.size(column), F.lit(0))
    return F.sum(per_row.cast("long"))


def measured_bytes(df: DataFrame) -> int:
    return df.agg(_plain_bytes(df).alias("n")).first()["n"] or 0


def stage_side(spark: SparkSession, df: DataFrame, path: str) -> Side:
    """Write a side table and learn its size while it is written: its plan runs once."""
    seen = Observation()
    df.observe(seen, _plain_bytes(df).alias("n")).write.parquet(path)
    return Side(spark.read.schema(df.schema).parquet(path), seen.get.get("n") or 0)


def side_join(left: DataFrame, side: DataFrame | Side, on, how: str, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Join with a side table: broadcast while it fits ``limit``, else shuffled.

    A table that is not staged is run once to be measured. The shuffled form gives the same rows;
    adaptive skew handling splits hot keys of ``left``.
    """
    table, size = side if isinstance(side, Side) else (side, measured_bytes(side))
    return left.join(F.broadcast(table) if size <= limit else table, on, how)


def keep_validated(df: DataFrame, validated: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Rows whose metric is on the validated list."""
    return side_join(df, validated.select("metric"), "metric", "left_semi", limit)


def new_metrics(seen: DataFrame, catalog: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Rows of ``seen`` whose metric the catalogue does not have yet."""
    return side_join(seen, catalog.select("metric"), "metric", "left_anti", limit)


def with_device_tags(
    df: DataFrame,
    registry: DataFrame,
    product_type: str,
    serial: str,
    on: str = "device",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Tags per device from a registry (unique on ``on``), the given pair where it has none."""
    tags = registry.select(on, "product_type", "serialNumber")
    joined = side_join(df, tags, on, "left", limit)
    return joined.withColumns(
        {
            "product_type": F.coalesce("product_type", F.lit(product_type)),
            "serialNumber": F.coalesce("serialNumber", F.lit(serial)),
        }
    )


def with_tags(df: DataFrame, product_type: str, serial: str) -> DataFrame:
    return df.withColumns({"product_type": F.lit(product_type), "serialNumber": F.lit(serial)})
