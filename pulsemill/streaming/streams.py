"""Streams over directories of reports, archives or samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsemill.operators.points import last_write_wins
from pulsemill.operators.series import aggregate_window
from pulsemill.plans.ingest import IngestOptions, StorePaths, ingest_archives, ingest_lines
from pulsemill.sinks.keyed import merge_keyed
from pulsemill.sources.archives import stream_archives
from pulsemill.sources.reports import with_line_position

# Text in a batch. A batch has some twenty jobs however small its files are, and holds none of it in memory.
BATCH_BYTES = 1 << 30


def ingest_available(
    spark: SparkSession,
    path: str,
    store: StorePaths,
    checkpoint: str,
    options: IngestOptions = IngestOptions(),
    archives: bool = False,
    files_per_batch: int | None = None,
    first_seq: int = 1,
    bytes_per_batch: int = BATCH_BYTES,
) -> None:
    """Load the files that wait in a directory, then stop.

    The checkpoint remembers what was loaded. A batch repeated after a failure has the same
    number and overwrites its own samples. A batch of text reports is bounded by its bytes, or by
    ``files_per_batch`` if that is given; archives that wait make one batch. ``first_seq`` numbers
    the first batch, for a store that other loads went into before.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        seq = first_seq + batch_id
        if archives:
            ingest_archives(batch.sparkSession, batch, store, seq, options)
        else:
            ingest_lines(batch.sparkSession, with_line_position(batch), store, seq, options)

    if archives:
        source = stream_archives(spark, path, f"{checkpoint}/archives")
    else:
        most = ("maxBytesPerTrigger", bytes_per_batch) if files_per_batch is None else ("maxFilesPerTrigger", files_per_batch)
        reader = spark.readStream.option(*most)
        # The metadata has to be selected here to reach the batch.
        source = reader.option("recursiveFileLookup", "true").text(path).select("value", "_metadata")
    query = (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_window(samples: DataFrame, every: str, lateness: str, series: list[str]) -> DataFrame:
    """Windowed means of a stream; a window is final once ``lateness`` has passed its end.

    In append mode only final windows come out; ``keep_updated`` also keeps the current ones.
    """
    return aggregate_window(samples.withWatermark("ts", lateness), every, series)


def stream_latest(samples: DataFrame, lateness: str, keys: list[str], order: list[str]) -> DataFrame:
    """The newest version of each key and time, as ``last_write_wins`` gives it for a batch.

    A streaming aggregate keeps one version for each key and forgets it once ``lateness`` has
    passed its time. In update mode a key comes out again whenever a newer version has come.
    """
    return last_write_wins(samples.withWatermark("ts", lateness), [*keys, "ts"], order)


def keep_updated(
    stream: DataFrame, root: str, keys: list[str], time: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Merge a stream's updates into a table with one row per key, open windows included.

    With ``every`` the table is refreshed at that interval until the returned query is stopped;
    without, over what is there, once. Read the table with ``read_keyed``.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_keyed(batch.sparkSession, batch, root, keys, time, batch_id)

    writer = stream.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint)
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_dedup(samples: DataFrame, lateness: str, keys: list[str]) -> DataFrame:
    """First arrival of each key; repeats within ``lateness`` are dropped."""
    return samples.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(keys)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over what is there and write it as Parquet."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def start_refreshing(stream: DataFrame, path: str, checkpoint: str, every: str = "30 seconds") -> StreamingQuery:
    """Keep a stream's Parquet output up to date until the returned query is stopped."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).start()


def as_event_time(df: DataFrame) -> DataFrame:
    """Watermarks need a zoned timestamp."""
    return df.withColumn("ts", F.col("ts").cast("timestamp"))
