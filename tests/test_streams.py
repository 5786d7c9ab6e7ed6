import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsemill.plans.ingest import IngestOptions, StorePaths, ingest_lines
from pulsemill.operators.points import last_write_wins
from pulsemill.sinks.keyed import merge_keyed, read_keyed
from pulsemill.sinks.samples import read_samples
from pulsemill.sources.reports import read_wide_reports
from pulsemill.streaming import streams as st

T0 = dt.datetime(2025, 10, 9, 12)


def report(path, names, minutes, shift=0):
    lines = [",".join(["Time", *names])]
    for m in minutes:
        lines.append(f"2025-10-09 12:{m:02d}:00," + ",".join(str(m + shift) for _ in names))
    path.write_text("\n".join(lines) + "\n")


def values(spark, store):
    rows = read_samples(spark, store.samples).select(F.date_format("ts", "HH:mm").alias("t"), "field", "value").collect()
    return {(x["t"], x["field"]): x["value"] for x in rows}


def test_directory_ingest_continues_where_it_stopped(spark, tmp_path):
    source, store = tmp_path / "in", StorePaths(str(tmp_path / "store"))
    source.mkdir()
    checkpoint = str(tmp_path / "checkpoint")
    report(source / "1.csv", ["a.b", "c"], range(10))
    report(source / "2.csv", ["c", "d"], range(20, 30))
    st.ingest_available(spark, str(source), store, checkpoint, files_per_batch=1)
    first = values(spark, store)
    assert len(first) == 40
    st.ingest_available(spark, str(source), store, checkpoint, files_per_batch=1)
    assert values(spark, store) == first
    report(source / "3.csv", ["c"], range(5), shift=100)
    st.ingest_available(spark, str(source), store, checkpoint, files_per_batch=1)
    later = values(spark, store)
    assert len(later) == 40 and later["12:03", "c"] == 103.0 and later["12:03", "a_b"] == 3.0
    ledger = spark.read.parquet(store.ledger)
    assert ledger.count() == 3 and ledger.select("ingest_seq").distinct().count() == 3


def test_stream_and_batch_give_the_same_store(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(4):
        report(source / f"{i}.csv", [f"m{i % 2}", "shared.x"], range(i * 5, i * 5 + 5))
    streamed, batch = StorePaths(str(tmp_path / "a")), StorePaths(str(tmp_path / "b"))
    st.ingest_available(spark, str(source), streamed, str(tmp_path / "checkpoint"), files_per_batch=3)
    ingest_lines(spark, read_wide_reports(spark, str(source)), batch, 1, IngestOptions())
    assert values(spark, streamed) == values(spark, batch)


def test_windows_close_after_lateness(spark, tmp_path):
    rows = [("m", T0 + dt.timedelta(minutes=m), float(m)) for m in range(0, 200, 5)]
    spark.createDataFrame(rows, "metric string, ts timestamp, value double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("metric string, ts timestamp, value double").parquet(str(tmp_path / "in"))
    st.run_available(st.stream_window(stream, "30 minutes", "30 minutes", ["metric"]), str(tmp_path / "out"), str(tmp_path / "c"))
    got = {x["t"].strftime("%H:%M"): x["value"] for x in spark.read.parquet(str(tmp_path / "out")).select(F.col("t").cast("timestamp_ntz").alias("t"), "value").collect()}
    # The last sample is at 15:15, so windows that end by 14:45 are final.
    assert got == {"12:30": 12.5, "13:00": 42.5, "13:30": 72.5, "14:00": 102.5, "14:30": 132.5}


def test_refreshing_output_grows_with_its_source(spark, tmp_path):
    schema = "metric string, ts timestamp, value double"
    write = lambda m: spark.createDataFrame([("m", T0 + dt.timedelta(minutes=m), 1.0)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    write(0)
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    means = st.stream_window(stream, "1 minute", "1 minute", ["metric"])
    query = st.start_refreshing(means, str(tmp_path / "out"), str(tmp_path / "c"), "1 second")
    try:
        for minute in (10, 20):
            write(minute)
            query.processAllAvailable()
    finally:
        query.stop()
    ends = {x["t"].strftime("%H:%M") for x in spark.read.parquet(str(tmp_path / "out")).select(F.col("t").cast("timestamp_ntz").alias("t")).collect()}
    assert ends == {"12:01", "12:11"}


MEANS = "metric string, t timestamp, value double"


def test_open_windows_are_kept_up_to_date(spark, tmp_path):
    """After every batch the table equals the batch result over all rows so far, the current window included."""
    schema, source, root = "metric string, ts timestamp, value double", str(tmp_path / "in"), str(tmp_path / "out")
    rows = [[("m", 0, 1.0), ("n", 70, 4.0)], [("m", 20, 3.0), ("m", 65, 5.0)], [("m", 30, 8.0)], [("n", 1500, 1.0), ("m", 61, 7.0)]]
    all_rows = []
    for part in rows:
        at = [(m, T0 + dt.timedelta(minutes=i), v) for m, i, v in part]
        all_rows += at
        spark.createDataFrame(at, schema).coalesce(1).write.mode("append").parquet(source)
        stream = st.stream_window(spark.readStream.schema(schema).parquet(source), "1 hour", "2 days", ["metric"])
        st.keep_updated(stream, root, ["metric", "t"], "t", str(tmp_path / "c"))
        got = read_keyed(spark, root, stream.schema).selectExpr("metric", "string(t) t", "value").collect()
        batch = st.aggregate_window(spark.createDataFrame(all_rows, schema), "1 hour", ["metric"])
        assert sorted(map(str, got)) == sorted(map(str, batch.selectExpr("metric", "string(t) t", "value").collect()))


def test_refreshing_windows(spark, tmp_path):
    schema, source, root = "metric string, ts timestamp, value double", str(tmp_path / "in"), str(tmp_path / "out")
    write = lambda m, v: spark.createDataFrame([("m", T0 + dt.timedelta(minutes=m), v)], schema).write.mode("append").parquet(source)
    write(0, 1.0)
    stream = st.stream_window(spark.readStream.schema(schema).parquet(source), "1 hour", "1 hour", ["metric"])
    query = st.keep_updated(stream, root, ["metric", "t"], "t", str(tmp_path / "c"), "1 second")
    try:
        for minute, value in ((5, 3.0), (70, 9.0)):
            write(minute, value)
            query.processAllAvailable()
    finally:
        query.stop()
    got = read_keyed(spark, root, stream.schema).orderBy("t").collect()
    assert [x["value"] for x in got] == [2.0, 9.0]


def batch(spark, *rows):
    return spark.createDataFrame([(m, T0 + dt.timedelta(days=d), v) for m, d, v in rows], MEANS)


def kept(spark, root):
    from pyspark.sql import types as T

    rows = read_keyed(spark, root, T.StructType.fromDDL(MEANS)).collect()
    return {(x["metric"], (x["t"].replace(tzinfo=None) - T0).days): x["value"] for x in rows}


def test_a_batch_repeated_or_late_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    put = lambda n, *rows: merge_keyed(spark, batch(spark, *rows), root, ["metric", "t"], "t", n)
    put(0, ("a", 0, 1.0), ("b", 0, 1.0), ("a", 1, 1.0))
    put(1, ("a", 0, 2.0))
    untouched = sorted(f.name for f in (tmp_path / "out" / "d=2025-10-10").glob("*.parquet"))
    once = kept(spark, root)
    put(1, ("a", 0, 2.0))
    put(0, ("a", 0, 1.0), ("b", 0, 1.0))
    assert kept(spark, root) == once == {("a", 0): 2.0, ("b", 0): 1.0, ("a", 1): 1.0}
    assert sorted(f.name for f in (tmp_path / "out" / "d=2025-10-10").glob("*.parquet")) == untouched


def test_a_batch_that_dies_while_replacing_loses_no_row(spark, tmp_path, monkeypatch):
    import shutil

    from pulsemill.sinks import keyed

    root = str(tmp_path / "out")
    merge_keyed(spark, batch(spark, ("a", 0, 1.0), ("b", 0, 1.0)), root, ["metric", "t"], "t", 0)
    real = keyed._overwrite

    def die(rows, root):
        shutil.rmtree(f"{root}/d=2025-10-09")
        raise RuntimeError("died")

    monkeypatch.setattr(keyed, "_overwrite", die)
    with pytest.raises(RuntimeError):
        merge_keyed(spark, batch(spark, ("a", 0, 2.0)), root, ["metric", "t"], "t", 1)
    monkeypatch.setattr(keyed, "_overwrite", real)
    merge_keyed(spark, batch(spark, ("c", 3, 5.0)), root, ["metric", "t"], "t", 2)
    assert kept(spark, root) == {("a", 0): 2.0, ("b", 0): 1.0, ("c", 3): 5.0}


def test_the_newest_version_wins_in_a_stream_too(spark, tmp_path):
    """Versions come in any order and in several batches; the table is what the batch aggregate gives."""
    schema, source, root = "s string, ts timestamp, seq long, value double", str(tmp_path / "in"), str(tmp_path / "out")
    parts = [[("a", 0, 2, 20.0), ("b", 0, 1, 1.0)], [("a", 0, 1, 10.0), ("b", 0, 3, 3.0)], [("b", 0, 2, 2.0), ("a", 1, 1, 5.0)]]
    for part in parts:
        rows = [(s, T0 + dt.timedelta(minutes=m), q, v) for s, m, q, v in part]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = st.stream_latest(spark.readStream.schema(schema).parquet(source), "1 hour", ["s"], ["seq"])
        st.keep_updated(stream, root, ["s", "ts"], "ts", str(tmp_path / "c"))
    got = read_keyed(spark, root, stream.schema).select("s", "ts", "seq", "value")
    want = last_write_wins(spark.read.parquet(source), ["s", "ts"], ["seq"]).select("s", "ts", "seq", "value")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 3


def test_many_small_files_make_one_batch(spark, tmp_path):
    """A batch is bounded by its bytes: a thousand small files more are no further batch."""
    source, store = tmp_path / "in", StorePaths(str(tmp_path / "store"))
    source.mkdir()
    for i in range(1_010):
        (source / f"{i:04}.csv").write_text(f"Time,a.b\n2025-10-09 12:{i // 60:02}:{i % 60:02},{i}\n")
    st.ingest_available(spark, str(source), store, str(tmp_path / "checkpoint"))
    ledger = spark.read.parquet(store.ledger)
    assert ledger.count() == 1_010 and ledger.select("ingest_seq").distinct().count() == 1
    assert read_samples(spark, store.samples).agg(F.count("*"), F.sum("value")).first()[:] == (1_010, sum(range(1_010)))
    for name in ("one", "two"):
        report(tmp_path / "in" / f"{name}.csv", ["a.b"], range(5))
    st.ingest_available(spark, str(source), store, str(tmp_path / "checkpoint"), bytes_per_batch=1)
    assert spark.read.parquet(store.ledger).select("ingest_seq").distinct().count() == 3
