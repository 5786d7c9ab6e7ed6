"""Streaming queries, run over what is there and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsemill.plans.ingest import StorePaths
from pulsemill.registered import views
from pulsemill.registered.registry import query
from pulsemill.registered.reports import STORED_SQL, report_devices, stored
from pulsemill.session import apply_settings, scratch_path
from pulsemill.sinks.keyed import read_keyed
from pulsemill.streaming import streams as st


def _event_stream(spark, sf):
    schema = views.table(spark, sf, "events").schema
    # A glob, because a stream takes folders and patterns but no single file.
    rows = spark.readStream.schema(schema).parquet(f"{sf}/event[s].parquet")
    return st.as_event_time(rows)


def _run(spark, stream, label):
    path = scratch_path(spark, label)
    st.run_available(stream, path, scratch_path(spark, f"{label}-checkpoint"))
    return spark.read.parquet(path)


def _kept(spark, stream, keys, time, label):
    """A stream's updates merged into a table, and the table."""
    root = scratch_path(spark, label)
    st.keep_updated(stream, root, keys, time, scratch_path(spark, f"{label}-checkpoint"))
    return read_keyed(spark, root, stream.schema)


@query(
    "q_stream_window",
    """select event_type, date_trunc('hour', ts) + interval 1 hour as t, round(avg(value) + 1e-9, 6) as value
      from events group by all""",
)
def stream_window(spark, sf):
    means = st.stream_window(_event_stream(spark, sf), "1 hour", "2 hours", ["event_type"])
    windows = _kept(spark, means, ["event_type", "t"], "t", "windows")
    return windows.select("event_type", F.col("t").cast("timestamp_ntz").alias("t"), F.round(F.col("value") + 1e-9, 6).alias("value"))


@query(
    "q_stream_latest",
    """+ loads as (
      select user_id, event_type, ts, value, event_id, 1 as seq from events
      union all select user_id, event_type, ts, value + 1, event_id, 2 from events where value > 20)
    select user_id, event_type, ts, cast(seq as bigint) as seq, value from loads
    qualify row_number() over (partition by user_id, event_type, ts order by seq desc, event_id desc) = 1""",
)
def stream_latest(spark, sf):
    """A stream of samples and one of corrections, in any order of arrival."""
    first = _event_stream(spark, sf).withColumn("seq", F.lit(1).cast("bigint"))
    corrected = _event_stream(spark, sf).filter("value > 20").withColumns({"seq": F.lit(2).cast("bigint"), "value": F.col("value") + 1})
    samples = corrected.unionByName(first).select("user_id", "event_type", "ts", "seq", "event_id", "value")
    newest = st.stream_latest(samples, "1 hour", ["user_id", "event_type"], ["seq", "event_id"])
    latest = _kept(spark, newest, ["user_id", "event_type", "ts"], "ts", "latest")
    return latest.select("user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "seq", "value")


@query("q_stream_dedup", "select event_id, event_type, ts, value from events")
def stream_dedup(spark, sf):
    twice = _event_stream(spark, sf).unionByName(_event_stream(spark, sf))
    once = _run(spark, st.stream_dedup(twice, "1 hour", ["event_id"]), "dedup")
    return once.select("event_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


@query("q_stream_ingest", STORED_SQL)
def stream_ingest(spark, sf):
    apply_settings(spark)
    path = views.write_reports(spark, sf)
    store = StorePaths(scratch_path(spark, "store"))
    checkpoint = scratch_path(spark, "ingest-checkpoint")
    # The second run finds nothing new.
    for _ in range(2):
        st.ingest_available(spark, path, store, checkpoint, report_devices(spark, sf))
    return stored(spark, store).select("product_type", "serialNumber", "ts", "metric", "field", "value")


@query("q_stream_archives", f"{STORED_SQL} where report % 7 < 3")
def stream_archives(spark, sf):
    apply_settings(spark)
    path = views.write_mixed_archives(spark, sf)
    store = StorePaths(scratch_path(spark, "store"))
    checkpoint = scratch_path(spark, "archives-checkpoint")
    for _ in range(2):
        st.ingest_available(spark, path, store, checkpoint, report_devices(spark, sf), archives=True)
    return stored(spark, store).select("product_type", "serialNumber", "ts", "metric", "field", "value")
