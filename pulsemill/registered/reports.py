"""Report reading, point identity and store queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsemill.operators import points as p
from pulsemill.operators import reports as r
from pulsemill.operators.catalog import seen_metrics
from pulsemill.operators.inventory import outcome_totals, run_ledger
from pulsemill.plans.ingest import IngestOptions, StorePaths, ingest_lines, read_lines
from pulsemill.plans.validation import ValidationPaths, valid_metrics
from pulsemill.registered import views
from pulsemill.registered.registry import query
from pulsemill.schema import SERIES
from pulsemill.session import scratch_path
from pulsemill.sinks import tables
from pulsemill.sinks.samples import indexed_tag_values, read_samples, read_spans
from pulsemill.sources.reports import read_wide_reports

_WIDE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ts", "metric", "value"]


def _ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("q_melt", f"select {', '.join(_WIDE)} from wide")
def melt(spark, sf):
    return r.melt(*views.wide_rows(spark, sf)).select(*_WIDE)


@query("q_skip_zero", f"select {', '.join(_WIDE)} from wide where value <> 0")
def skip_zero(spark, sf):
    return r.value_filter(r.melt(*views.wide_rows(spark, sf)), ["skip_zero", "skip_empty"]).select(*_WIDE)


@query(
    "q_last_write_wins",
    'select product_type, "serialNumber", ts, field, value from wide_samples',
)
def last_write_wins(spark, sf):
    return views.wide_samples(spark, sf).drop("measurement")


@query(
    "q_sanitize_collision",
    """+ cells as (
      select event_id, ts, 'a.b' as metric, 1 as pos, value from events where event_id % 3 <> 0
      union all select event_id, ts, 'a-b', 2, value * 2 from events where event_id % 2 = 0)
    select event_id, ts, 'a_b' as field, arg_max(metric, pos) as metric, max(pos) as pos, arg_max(value, pos) as value
    from cells group by all""",
)
def sanitize_collision(spark, sf):
    odd, even = F.col("event_id") % 3 != 0, F.col("event_id") % 2 == 0
    numbers = F.array(F.when(odd, F.col("value")), F.when(even, F.col("value") * 2))
    rows = views.table(spark, sf, "events").select(
        "event_id", "ts", F.lit(1).cast("long").alias("header_id"), numbers.alias("numbers")
    )
    values = r.melt(rows, views.header_columns(spark, ["a.b", "a-b"]))
    resolved = p.resolve_collisions(values, ["event_id", "ts"])
    return resolved.select("event_id", "ts", "field", "metric", "pos", "value")


@query(
    "q_assemble_points",
    """select product_type, "serialNumber", ts,
      string_agg(field || '=' || regexp_replace(cast(value as varchar), '\\.0$', ''), ',' order by field) as fields
    from wide_samples group by all""",
)
def assemble_points(spark, sf):
    points = views.wide_points(spark, sf)
    text = F.transform(
        F.array_sort(F.map_entries("fields")), lambda e: F.concat(e["key"], F.lit("="), p.number_text(e["value"]))
    )
    return points.select("product_type", "serialNumber", "ts", F.array_join(text, ",").alias("fields"))


@query("q_points_roundtrip", 'select measurement, product_type, "serialNumber", ts, field, value from wide_samples')
def points_roundtrip(spark, sf):
    return p.explode_points(p.assemble_points(views.wide_samples(spark, sf)))


@query(
    "q_line_protocol",
    """select 'line\\ item,product_type=' || product_type || ',serialNumber=' || "serialNumber" || ' ' ||
      string_agg(field || '=' || regexp_replace(cast(value as varchar), '\\.0$', ''), ',' order by field)
      || ' ' || cast(epoch_us(ts) * 1000 as varchar) as line
    from wide_samples group by measurement, product_type, "serialNumber", ts""",
)
def line_protocol(spark, sf):
    path = scratch_path(spark, "points")
    tables.write_line_protocol(p.to_line_protocol(views.wide_points(spark, sf)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(
    "q_nonempty_points",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
      cast((l_discount <> 0)::int + (l_tax <> 0)::int as bigint) as n_fields
    from lineitem where l_discount <> 0 or l_tax <> 0""",
)
def nonempty_points(spark, sf):
    cells = F.create_map(F.lit("l_discount"), "l_discount", F.lit("l_tax"), "l_tax")
    points = views.table(spark, sf, "lineitem").withColumn("fields", F.map_filter(cells, lambda _, v: v != 0))
    kept = p.nonempty_points(points)
    return kept.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.size("fields").cast("long").alias("n_fields")
    )


@query(
    "q_union_sources",
    """+ loads as (
      select measurement, product_type, "serialNumber", field, ts, value, event_id, 1 as seq from telemetry
      union all select measurement, product_type, "serialNumber", field, ts, value + 1, event_id, 2 from telemetry where value > 20)
    select measurement, product_type, "serialNumber", field, ts, cast(seq as bigint) as ingest_seq, value from loads
    qualify row_number() over (partition by measurement, product_type, "serialNumber", field, ts
      order by seq desc, event_id desc) = 1""",
)
def union_sources(spark, sf):
    samples = views.telemetry(spark, sf)
    corrected = samples.filter("value > 20").withColumn("value", F.col("value") + 1)
    merged = p.union_samples(views.sample_rows(samples, 1), views.sample_rows(corrected, 2))
    return merged.select(*SERIES, "ts", "ingest_seq", "value")


# --- queries over report files ------------------------------------------------------------


def _reports(spark, sf):
    path = views.write_reports(spark, sf)
    return read_wide_reports(spark, path)


@query("q_header_join", "select report, ts, metric, value from report_values")
def header_join(spark, sf):
    lines = _reports(spark, sf)
    headers = r.read_headers(spark, lines)
    values = r.melt(read_lines(lines, headers), headers.side)
    named = values.select(views.report_number(F.col("archive")).alias("report"), "ts", "metric", "value")
    return _ntz(named, "ts")


@query(
    "q_parse_report",
    """select report, ts, metric, translate(metric, '.- ', '___') as field, cast(pos as int) as pos, value
    from report_values where value <> 0 and metric not like 'proc.%'""",
)
def parse_report(spark, sf):
    lines = _reports(spark, sf)
    headers = r.read_headers(spark, lines, r.category_filter)
    rows = r.check_ts(r.check_arity(read_lines(lines, headers)))
    values = r.value_filter(r.melt(rows, headers.side), ["skip_zero"])
    named = values.select(
        views.report_number(F.col("archive")).alias("report"), "ts", "metric", "field", "pos", "value"
    )
    return _ntz(named, "ts")


# Counters of every report, from its lines.
COUNTERS_SQL = """+ per_line as (
      select report, bad_arity, bad_ts, not bad_arity and not bad_ts as usable, kind in (2, 3) as is_text,
        kind not in (2, 3) and (kind = 4 or value = 0) as is_zero,
        variant = 2 and metric = 'mem.util.free' and event_id % 2 = 0 as extra,
        case when variant = 2 then 6 else 5 end as width
      from report_lines),
    counters as (
    select report, count(*) as lines,
      count(*) filter (usable and (not is_text and not is_zero or extra)) as points,
      cast(sum(case when usable then (not is_text and not is_zero)::int + extra::int else 0 end) as bigint) as values,
      cast(sum(case when usable then width - 1 - extra::int else 0 end) as bigint) as skipped_null,
      count(*) filter (usable and is_text) as skipped_text,
      count(*) filter (usable and is_zero) as skipped_filtered,
      count(*) filter (bad_arity) as bad_arity,
      count(*) filter (bad_ts and not bad_arity) as bad_ts
    from per_line group by report)"""


@query("q_ingest_counters", f"{COUNTERS_SQL} select * from counters")
def ingest_counters(spark, sf):
    lines = _reports(spark, sf)
    rows = read_lines(lines, r.read_headers(spark, lines))
    counters = r.ingest_counters(rows, ["skip_zero"])
    return counters.withColumn("report", views.report_number(F.col("archive"))).drop("archive")


@query(
    "q_metric_profile",
    f"""+ cells as (
      select l.report, l.ts, l.event_id, h.metric,
        case when h.metric = l.metric then (case when kind in (2, 3) then 'text' else 'number' end)
          when h.metric = 'mem-util-free' and l.metric = 'mem.util.free' and event_id % 2 = 0 then 'number' else 'null' end as kind
      from report_lines l, (select unnest(['{"', '".join([*views.EVENT_METRICS.values(), "mem-util-free"])}']) as metric) h
      where not bad_arity and not bad_ts and (h.metric <> 'mem-util-free' or variant = 2))
    select metric, count(*) as total, count(*) filter (kind = 'number') as numeric,
      count(*) filter (kind = 'null') as null_token, count(*) filter (kind = 'text') as text,
      min(ts) as min_ts, max(ts) as max_ts, count(*) filter (kind = 'number') > 0 as valid
    from cells group by metric""",
)
def metric_profile(spark, sf):
    lines = _reports(spark, sf)
    headers = r.read_headers(spark, lines)
    rows = r.check_ts(r.check_arity(r.parse_lines(r.attach_header(lines, headers))))
    return _ntz(r.metric_profile(rows, headers.side), "min_ts", "max_ts")


@query(
    "q_bronze_roundtrip",
    """select report, count(*) + 2 as n, count(*) + 1 as n_filled from report_lines group by report""",
)
def bronze_roundtrip(spark, sf):
    path = scratch_path(spark, "bronze")
    tables.write_bronze(_reports(spark, sf), path)
    kept = spark.read.parquet(path).withColumn("report", views.report_number(F.col("archive")))
    return kept.groupBy("report").agg(F.count("*").alias("n"), F.count_if(F.trim("line") != "").alias("n_filled"))


def report_devices(spark, sf):
    """Each report is a device: its number is the serial."""
    device = F.floor(F.col("event_id") / views.REPORT_LINES).alias("device")
    devices = views.table(spark, sf, "events").select(device).distinct()
    registry = devices.select(
        "device",
        F.concat(F.lit("RACK"), (F.col("device") % 4).cast("string")).alias("product_type"),
        F.col("device").cast("string").alias("serialNumber"),
    )
    return IngestOptions(registry=registry, device_key=views.report_number, categories={"proc": True, "nfs": True})


STORED_SQL = """select 'RACK' || cast(report % 4 as varchar) as product_type, cast(report as varchar) as "serialNumber",
      ts, metric, field, value from report_samples"""


def stored(spark, store):
    return _ntz(read_samples(spark, store.samples), "ts")


@query("q_store_upsert", STORED_SQL)
def store_upsert(spark, sf):
    lines = _reports(spark, sf)
    store = StorePaths(scratch_path(spark, "store"))
    for load in (1, 2):
        ingest_lines(spark, lines, store, load, report_devices(spark, sf))
    return stored(spark, store).select("product_type", "serialNumber", "ts", "metric", "field", "value")


@query(
    "q_store_catalog",
    """select metric, cast(1 as bigint) as first_seq, arg_min(report, (report, pos)) as report,
      cast(arg_min(pos, (report, pos)) as int) as first_pos
    from (select distinct metric, lpad(cast(report as varchar), 9, '0') as padded, report, pos from report_values) group by metric""",
)
def store_catalog(spark, sf):
    lines = _reports(spark, sf).withColumn(
        "archive", F.format_string("report=%09d", views.report_number(F.col("archive")))
    )
    headers = r.read_headers(spark, lines)
    rows = read_lines(lines, headers)
    path = scratch_path(spark, "catalog")
    for load in (1, 2):
        seen = r.numeric_columns(rows, headers.side).withColumn("ingest_seq", F.lit(load).cast("long"))
        tables.append_catalog(spark, seen_metrics(seen), path)
    return tables.read_catalog(spark, path).select(
        "metric", "first_seq", views.report_number(F.col("first_archive")).alias("report"), "first_pos"
    )


@query(
    "q_run_ledger",
    "select 'processed' as status, count(distinct report) as n from report_lines",
)
def ledger(spark, sf):
    lines = _reports(spark, sf)
    path = scratch_path(spark, "ledger")
    counters = r.ingest_counters(read_lines(lines, r.read_headers(spark, lines)))
    tables.append_ledger(run_ledger(counters, 1), path)
    return outcome_totals(spark.read.parquet(path))


@query(
    "q_index_tag_values",
    """+ recent as (select report from report_samples where ts >= (select max(ts) from report_samples) - interval 2 days)
    select distinct 'product_type' as tag, 'RACK' || cast(report % 4 as varchar) as value from recent
    union all select distinct 'serialNumber', cast(report as varchar) from recent where report % 4 = 1""",
)
def index_tag_values(spark, sf):
    """Dashboard variables from the store's index of time spans; the samples are only written."""
    store = StorePaths(scratch_path(spark, "store"))
    ingest_lines(spark, _reports(spark, sf), store, 1, report_devices(spark, sf))
    newest = read_spans(spark, store.samples).agg(F.date_format(F.max("high"), "yyyy-MM-dd HH:mm:ss").alias("at")).first()["at"]
    products = indexed_tag_values(spark, store.samples, "product_type", "2 days", newest)
    serials = indexed_tag_values(spark, store.samples, "serialNumber", "2 days", newest, F.col("product_type") == "RACK1")
    return products.select(F.lit("product_type").alias("tag"), F.col("product_type").alias("value")).unionByName(
        serials.select(F.lit("serialNumber").alias("tag"), F.col("serialNumber").alias("value"))
    )


@query(
    "q_validate_or_load",
    """+ sighted as (
      select distinct report, metric from report_lines where not bad_arity and not bad_ts and kind not in (2, 3)
      union select distinct report, 'mem-util-free' from report_lines
        where not bad_arity and not bad_ts and variant = 2 and metric = 'mem.util.free' and event_id % 2 = 0),
    headed as (
      select distinct unnest(['kernel.all.load-1 minute', 'disk.dev.read-sda', 'mem.util.free', 'proc.psinfo.utime-000001',
        'network.interface.in.bytes-eth0']) as metric
      union select 'mem-util-free' from report_lines where variant = 2)
    select 'validated' as step, metric from sighted where report % 3 < 2 group by metric
    union all select 'loaded', metric from sighted where report % 3 < 2 group by metric
    union all select 'validated again', metric from sighted group by metric
    union all select 'unvalidated', metric from headed""",
)
def validate_or_load(spark, sf):
    """A list from part of the reports; the same list while it is kept, whatever came since; a new one,
    profiling only the reports that are new, after it was emptied; and all names without validation."""
    lines = _reports(spark, sf)
    some = lines.filter(views.report_number(F.col("archive")) % 3 < 2)
    paths = ValidationPaths(scratch_path(spark, "validation"))
    every = {"proc": True, "nfs": True}

    def step(name, given, **more):
        path = scratch_path(spark, "names")
        valid_metrics(spark, given, paths, every, **more).select(F.lit(name).alias("step"), "metric").write.parquet(path)
        return spark.read.parquet(path)

    done = step("validated", some).unionByName(step("loaded", lines))
    tables.write_validated(spark.createDataFrame([], "metric string"), paths.validated)
    return done.unionByName(step("validated again", lines)).unionByName(step("unvalidated", lines, skip=True))
