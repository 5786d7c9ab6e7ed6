"""Small helpers the corpus operators share: text columns through Arrow, and staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm.text import slices
from pulsemill.session import scratch_path

# Shuffle files of a staged step go when the step is written, not at the driver's next garbage collection.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_column(
    function: Callable[[pa.Array, Any], pa.Array], returns: str, prepare: Callable[[], Any] | None = None
) -> Callable[[str], Column]:
    """A column function over texts, applied to runs of rows of about 0.5 MB.

    ``prepare`` is called once per task; what it returns is handed to every call of ``function``.
    """

    @F.arrow_udf(returns)
    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        state = prepare() if prepare else None
        for column in columns:
            parts = [function(column.slice(a, z - a), state) for a, z in slices(column)]
            yield pa.concat_arrays(parts) if parts else function(column, state)

    return apply


def map_texts(
    df: DataFrame,
    function: Callable[[pa.RecordBatch, Any], pa.RecordBatch],
    schema: str,
    text: str = "text",
    prepare: Callable[[], Any] | None = None,
) -> DataFrame:
    """Turn rows with a text into other rows, any number of them, by runs of about 0.5 MB of text."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = prepare() if prepare else None
        for batch in batches:
            for a, z in slices(batch[text]):
                yield function(batch.slice(a, z - a), state)

    return df.mapInArrow(apply, schema)


def struct_array(**columns: pa.Array) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(columns.values()), list(columns))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have in any spelling."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a step's rows to the shared scratch folder and read them back: lineage ends here."""
    path = scratch_path(spark, label)
    spark.conf.set(_CLEAN, "true")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
