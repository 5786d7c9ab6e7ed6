"""Telemetry views of the given tables, and report files that Spark derives from them."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.functions.scalars import sanitize_field
from pulsemill.operators.points import resolve_lines
from pulsemill.operators.reports import assemble_lines, melt_fields
from pulsemill.schema import DEFAULT_MEASUREMENT
from pulsemill.session import apply_settings, scratch_path

EVENT_METRICS = {
    "click": "kernel.all.load-1 minute",
    "error": "disk.dev.read-sda",
    "purchase": "mem.util.free",
    "signup": "proc.psinfo.utime-000001",
    "view": "network.interface.in.bytes-eth0",
}
PANEL_METRICS = [
    "psoc.now.cpu.cpu0",
    "psoc.now.cpu.cpu1",
    "psoc.now.temp.psoc",
    "psoc.now.temp.sensor1",
    "psoc.now.vltg.1v0",
    "psoc.now.vltg.3v3",
    "psoc.now.cur.3v3bus",
    "psoc.now.cur.poe",
    "psoc.now.fan.rpm",
    "psoc.now.fan.duty",
    "psoc.now.heater.state",
    "psoc.now.status.fan",
    "psoc.now.status.heater",
    "kernel.all.cpu.user",
    "kernel.all.cpu.sys",
    "kernel.all.cpu.idle",
    "mem.util.used",
    "mem.util.free",
    "disk.dev.read_bytes-sda",
    "network.interface.in.bytes-eth0",
]
WIDE_FIELDS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
REPORT_LINES = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return apply_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _event_metric() -> Column:
    metric = F.lit(None)
    for event_type, name in EVENT_METRICS.items():
        metric = F.when(F.col("event_type") == event_type, F.lit(name)).otherwise(metric)
    return metric


def _tags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "measurement": F.lit(DEFAULT_MEASUREMENT),
            "product_type": F.concat(F.lit("SERVER"), (F.col("user_id") % 12).cast("string")),
            "serialNumber": F.col("user_id").cast("string"),
        }
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as samples: the user is the device, the event type the metric."""
    named = _tags(table(spark, sf_dir, "events")).withColumn("metric", _event_metric())
    return named.withColumn("field", sanitize_field(F.col("metric"))).select(
        "event_id", "user_id", "ts", "measurement", "product_type", "serialNumber", "metric", "field", "value"
    )


def panel_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as sensor samples, spread evenly over the names the saved panels ask for."""
    names = F.array(*[F.lit(m) for m in PANEL_METRICS])
    tagged = _tags(table(spark, sf_dir, "events"))
    metric = F.get(names, (F.col("event_id") % len(PANEL_METRICS)).cast("int"))
    return tagged.select("event_id", "ts", "product_type", "serialNumber", metric.alias("metric"), "value")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings of metric-instance names, whose number grows with the devices."""
    samples = telemetry(spark, sf_dir)
    return samples.select(
        F.concat("metric", F.lit("-"), "serialNumber").alias("metric"),
        "ts",
        F.lit(1).cast("long").alias("ingest_seq"),
        F.format_string("run%08d", F.floor(F.col("event_id") / REPORT_LINES)).alias("archive"),
        (F.col("event_id") % REPORT_LINES).cast("int").alias("pos"),
    )


def sample_rows(samples: DataFrame, ingest_seq: int) -> DataFrame:
    """Fill in the load columns of the canonical long table."""
    return samples.select(
        "measurement", "product_type", "serialNumber", "ts", "metric", "field",
        F.lit(1).alias("pos"), "value", F.lit("events").alias("archive"),
        F.lit(0).cast("long").alias("block_start"), F.col("event_id").alias("row_id"),
        F.lit(ingest_seq).cast("long").alias("ingest_seq"), F.to_date("ts").alias("d"),
    )


WIDE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def wide_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """lineitem as report rows with four numeric cells, and their header columns."""
    items = table(spark, sf_dir, "lineitem")
    # A line without a time has no use for a header. A bare constant would leave its join without a key.
    header_id = F.when(F.col("l_shipdate").isNotNull(), F.lit(1).cast("long"))
    rows = items.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus",
        F.col("l_shipdate").alias("ts"), header_id.alias("header_id"),
        F.array(*WIDE_FIELDS).alias("numbers"),
    )
    return rows, header_columns(spark, WIDE_FIELDS)


def header_columns(spark: SparkSession, metrics: list[str], header_id: int = 1) -> DataFrame:
    names = [(header_id, slot, slot + 1, m) for slot, m in enumerate(metrics)]
    columns = spark.createDataFrame(names, "header_id long, slot int, pos int, metric string")
    return columns.withColumn("field", sanitize_field(F.col("metric")))


_WIDE_KEY = ["l_returnflag", "l_linestatus", "ts"]


def _wide_tags(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        F.lit("line item").alias("measurement"),
        F.col("l_returnflag").alias("product_type"),
        F.col("l_linestatus").alias("serialNumber"),
        "ts", *columns,
    )


def wide_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem in long form, one value per (flag, status, ship date, field)."""
    rows, columns = wide_rows(spark, sf_dir)
    return _wide_tags(melt_fields(resolve_lines(rows, _WIDE_KEY, WIDE_ORDER), columns, WIDE_ORDER), "field", "value")


def wide_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as points: one row per (flag, status, ship date) with its fields."""
    rows, columns = wide_rows(spark, sf_dir)
    return _wide_tags(assemble_lines(resolve_lines(rows, _WIDE_KEY, WIDE_ORDER), columns, WIDE_ORDER), "fields")


# --- report files -------------------------------------------------------------------------
# Every 1000 events make one report, with one of three headers. The third names two metrics
# that share a field name. Some lines and cells are damaged, by event_id, in every way the
# reader has to cope with.

_NAMES = list(EVENT_METRICS.values())
REPORT_HEADERS = [_NAMES, _NAMES[::-1], [*_NAMES, "mem-util-free"]]


def _own_cell() -> Column:
    text, kind = F.col("value").cast("string"), F.col("event_id") % 10
    return (
        F.when(kind == 0, F.concat(F.lit('"'), text, F.lit('"')))
        .when(kind == 1, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(kind == 2, "abc")
        .when(kind == 3, "1e999")
        .when(kind == 4, "0.000")
        .otherwise(text)
    )


def _empty_cell(place: int) -> Column:
    tokens = F.array(*[F.lit(t) for t in ["", "N/A", "?", "none", "NULL"]])
    return F.get(tokens, ((F.col("event_id") + place) % 5).cast("int"))


def _data_line(header: list[str]) -> Column:
    stamp = F.when(F.col("event_id") % 11 == 0, "bad").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    cells = []
    for place, name in enumerate(header):
        if name == "mem-util-free":
            shared = (F.col("metric") == "mem.util.free") & (F.col("event_id") % 2 == 0)
            cells.append(F.when(shared, (F.col("value") + 1).cast("string")).otherwise(_empty_cell(place)))
        else:
            cells.append(F.when(F.col("metric") == name, _own_cell()).otherwise(_empty_cell(place)))
    extra = F.when(F.col("event_id") % 13 == 0, ",9").otherwise("")
    return F.concat(F.concat_ws(",", stamp, *cells), extra)


def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines (report, seq, line) of the derived reports: a blank line, the header, the data."""
    numbered = telemetry(spark, sf_dir).withColumn("report", F.floor(F.col("event_id") / REPORT_LINES))
    variant = F.col("report") % len(REPORT_HEADERS)
    data, head = F.lit(None), F.lit(None)
    for i, header in enumerate(REPORT_HEADERS):
        data = F.when(variant == i, _data_line(header)).otherwise(data)
        head = F.when(variant == i, F.lit(",".join(f'"{c}"' for c in ["Time", *header]))).otherwise(head)
    lines = numbered.select("report", F.col("event_id").alias("seq"), data.alias("line"))
    reports = numbered.select("report").distinct()
    heads = reports.select("report", F.lit(-1).cast("long").alias("seq"), head.alias("line"))
    blanks = reports.select("report", F.lit(-2).cast("long").alias("seq"), F.lit("").alias("line"))
    return lines.unionByName(heads).unionByName(blanks)


def write_reports(spark: SparkSession, sf_dir: str) -> str:
    """Write the reports as text, one file each (a report is 1000 lines)."""
    path = scratch_path(spark, "reports")
    ordered = report_text(spark, sf_dir).repartition("report").sortWithinPartitions("report", "seq")
    ordered.select("report", "line").write.partitionBy("report").text(path)
    return path


def report_number(path: Column) -> Column:
    return F.regexp_extract(path, r"report=(\d+)", 1).cast("long")


def write_archives(spark: SparkSession, sf_dir: str) -> str:
    """Write the reports as .tar.xz; every fifth one is cut off, and the archives of report
    numbers that leave 3 have no report inside."""
    names = {3: "notes.bin"}
    return _pack_reports(
        spark,
        sf_dir,
        lambda report: f"report={report}.tar.xz",
        lambda report, text: (names.get(report % 5, "logs/day/report.csv"), text),
        lambda report: report % 5 == 4,
    )


def write_mixed_archives(spark: SparkSession, sf_dir: str) -> str:
    """The same under names with glob characters. By report number modulo 7: whole (0 and 1), behind
    1,500 blank lines (2), without a report (3), cut off (4), blank lines only (5), empty (6)."""

    def member(report: int, text: str) -> tuple[str, str]:
        kind = report % 7
        given = {2: "\n" * 1500 + text, 5: "\n" * 1500, 6: ""}
        return "notes.bin" if kind == 3 else "logs/day/report.csv", given.get(kind, text)

    return _pack_reports(spark, sf_dir, lambda report: f"run[report={report}].tar.xz", member, lambda report: report % 7 == 4)


def _pack_reports(
    spark: SparkSession,
    sf_dir: str,
    name: Callable[[int], str],
    member: Callable[[int, str], tuple[str, str]],
    cut: Callable[[int], bool],
) -> str:
    path = scratch_path(spark, "archives")

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        report = int(group["report"].iloc[0])
        inside, text = member(report, "\n".join(group.sort_values("seq")["line"]) + "\n")
        buffer = io.BytesIO()
        with tarfile.open(fileobj=buffer, mode="w:xz") as archive:
            entry = tarfile.TarInfo(inside)
            data = text.encode()
            entry.size = len(data)
            archive.addfile(entry, io.BytesIO(data))
        content = buffer.getvalue()
        _write_bytes(f"{path}/input/{name(report)}", content[: len(content) // 2] if cut(report) else content)
        return pd.DataFrame({"report": [report]})

    # A report is at most 1000 lines, so a group is small however large the table.
    packed = report_text(spark, sf_dir).groupBy("report").applyInPandas(pack, "report long")
    packed.agg(F.count("*")).first()
    return path


def _write_bytes(path: str, content: bytes) -> None:
    from pyarrow import fs

    filesystem, inner = (fs.LocalFileSystem(), path.removeprefix("file:")) if path.startswith(("/", "file:")) else fs.FileSystem.from_uri(path)
    filesystem.create_dir(inner.rpartition("/")[0], recursive=True)
    with filesystem.open_output_stream(inner) as out:
        out.write(content)
