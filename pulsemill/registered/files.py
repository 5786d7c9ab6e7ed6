"""Archive, inventory and log queries over files that Spark writes from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsemill.operators import inventory as inv
from pulsemill.operators import reports as r
from pulsemill.plans.ingest import IngestOptions, StorePaths, ingest_archives, read_lines
from pulsemill.registered import views
from pulsemill.registered.registry import query
from pulsemill.registered.reports import COUNTERS_SQL
from pulsemill.session import scratch_path
from pulsemill.sinks import tables
from pulsemill.sources.archives import archive_inventory, expand_archives, quarantine, report_headers
from pulsemill.sources.reports import read_parser_log

_FILES = "+ files as (select distinct event_id // 1000 as report from events)"


@query(
    "q_archive_inventory",
    f"""{_FILES} select 'report=' || report || '.tar.xz' as name, 'report=' || report as archive, 'input' as state,
      true as sized from files""",
)
def inventory(spark, sf):
    files = inv.newest_first(archive_inventory(spark, views.write_archives(spark, sf)))
    sized = (F.col("size") > 0) & (F.col("size_mb") <= F.col("size_kb")) & F.col("modified").isNotNull()
    return files.select("name", "archive", "state", sized.alias("sized"))


@query("q_state_counts", f"{_FILES} select 'input' as state, count(*) as n from files")
def state_counts(spark, sf):
    return inv.state_counts(archive_inventory(spark, views.write_archives(spark, sf)))


@query(
    "q_archive_expand",
    "select report, ts, metric, value from report_values where report % 5 < 3",
)
def expand(spark, sf):
    path = scratch_path(spark, "expanded")
    tables.write_bronze(expand_archives(spark, views.write_archives(spark, sf)), path)
    expanded = spark.read.parquet(path)
    good, _ = quarantine(expanded)
    headers = r.read_headers(spark, good, first_lines=report_headers(expanded))
    values = r.melt(read_lines(good, headers), headers.side)
    named = values.select(views.report_number(F.col("archive")).alias("report"), "ts", "metric", "value")
    return named.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "q_archive_quarantine",
    f"""{_FILES} select report, case when report % 5 = 3 then 'no report in archive' else 'damaged' end as reason
    from files where report % 5 >= 3""",
)
def failed(spark, sf):
    _, rejected = quarantine(expand_archives(spark, views.write_archives(spark, sf)))
    reason = F.when(F.col("error") == "no report in archive", F.col("error")).otherwise("damaged")
    return rejected.select(views.report_number(F.col("archive")).alias("report"), reason.alias("reason"))


def _mixed_store(spark, sf):
    store = StorePaths(scratch_path(spark, "store"))
    expanded = expand_archives(spark, views.write_mixed_archives(spark, sf))
    ingest_archives(spark, expanded, store, 1, IngestOptions(policy=("skip_zero",), categories={"proc": True, "nfs": True}))
    return store


@query(
    "q_archive_ledger",
    f"""{_FILES} select case when report % 7 < 3 then 'processed' else 'failed' end as status, count(*) as n
    from files group by all""",
)
def archive_ledger(spark, sf):
    return inv.outcome_totals(spark.read.parquet(_mixed_store(spark, sf).ledger))


_COUNTERS = ["lines", "points", "values", "skipped_null", "skipped_text", "skipped_filtered", "bad_arity", "bad_ts"]


@query(
    "q_archive_outcomes",
    f"""{COUNTERS_SQL}
    select cast(1 as bigint) as ingest_seq, report, case when report % 7 < 3 then 'processed' else 'failed' end as status,
      case report % 7 when 3 then 'no report in archive' when 4 then 'damaged' when 5 then 'no lines in report'
        when 6 then 'no lines in report' end as reason,
      {", ".join(f"case when report % 7 < 3 then {c} else 0 end as {c}" for c in _COUNTERS)}
    from counters""",
)
def archive_outcomes(spark, sf):
    ledger = spark.read.parquet(_mixed_store(spark, sf).ledger)
    known = F.col("error").isNull() | F.col("error").startswith("no ")
    reason = F.when(known, F.col("error")).otherwise("damaged")
    return ledger.select(
        F.col("ingest_seq").cast("long").alias("ingest_seq"),
        views.report_number(F.col("archive")).alias("report"), "status", reason.alias("reason"), *_COUNTERS,
    )


# --- logs ---------------------------------------------------------------------------------

_LOG = """+ log_lines as (select 'svc' || (user_id % 7) as log, event_id, date_trunc('second', ts) as ts,
      event_type || ' ' || event_id as message, event_id % 6 = 0 as blank from events)"""


def _log_text(spark, sf):
    events = views.table(spark, sf, "events")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    message = F.concat("event_type", F.lit(" "), F.col("event_id").cast("string"))
    line = F.when(F.col("event_id") % 6 == 0, "").otherwise(F.concat(F.lit("["), stamp, F.lit("] "), message))
    return events.select(
        F.concat(F.lit("svc"), (F.col("user_id") % 7).cast("string")).alias("log"), "event_id", line.alias("line")
    )


@query(
    "q_log_tail",
    f"""{_LOG} , tail as (select *, row_number() over (partition by log order by event_id desc) as rn from log_lines)
    select log, ts, message from tail where rn <= 5 and not blank""",
)
def log_tail(spark, sf):
    path = scratch_path(spark, "logs")
    # Range partitioned, so a long log becomes several files that sort by name.
    text = _log_text(spark, sf).repartitionByRange("log", "event_id").sortWithinPartitions("log", "event_id")
    text.select("log", "line").write.partitionBy("log").text(path)
    folder = F.regexp_extract("path", "/log=([^/]*)/[^/]*$", 1)
    tail = inv.last_n_lines(read_parser_log(spark, path, log=folder))
    return tail.select("log", F.col("ts").cast("timestamp_ntz").alias("ts"), "message")


@query(
    "q_last_n",
    f"""{_LOG} , tail as (select *, row_number() over (partition by log order by event_id desc) as rn from log_lines)
    select log, event_id from tail where rn <= 5 and not blank""",
)
def last_n(spark, sf):
    return inv.last_n_lines(_log_text(spark, sf), 5, ("event_id",)).select("log", "event_id")
