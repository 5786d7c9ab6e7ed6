"""Range, predicate, window, summary, pivot and resampling queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from pulsemill.operators import joins
from pulsemill.operators import series as s
from pulsemill.plans.panels import SAVED_PANELS, generated_panel, panel_legend, panel_query
from pulsemill.registered.registry import query
from pulsemill.registered.views import PANEL_METRICS, panel_samples, table, telemetry
from pulsemill.schema import DEFAULT_MEASUREMENT, SERIES, TAGS
from pulsemill.session import scratch_path

START, STOP = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
# A range that cuts its first and last window.
CUT_START, CUT_STOP = "2024-01-02 06:30:00", "2024-01-29 17:45:00"
EVERY = "1 hour"
WHOLE = f"ts >= timestamp '{START}' and ts < timestamp '{STOP}'"
CUT = f"ts >= timestamp '{CUT_START}' and ts < timestamp '{CUT_STOP}'"
CUT_T = f"least(date_trunc('hour', ts) + interval 1 hour, timestamp '{CUT_STOP}')"
WHOLE_T = f"least(date_trunc('hour', ts) + interval 1 hour, timestamp '{STOP}')"
KEYS = [*TAGS, "metric"]


def _rounded(df, *columns):
    """Round for comparison. The nudge keeps exact halves, which engines round differently,
    off the edge."""
    return df.withColumns({c: F.round(F.col(f"`{c}`") + 1e-9, 6) for c in columns})


@query(
    "q_panel_window",
    f"""select product_type, "serialNumber", metric, {CUT_T} as t, round(avg(value) + 1e-9, 6) as value
    from telemetry where {CUT} and regexp_matches(product_type, 'SERVER1') and metric like 'kernel.%' group by all""",
)
def panel_window(spark, sf):
    rows = s.where_metric(s.tag_regex(telemetry(spark, sf), "product_type", "SERVER1"), r"^kernel\.")
    return _rounded(s.aggregate_window(rows, EVERY, KEYS, CUT_START, CUT_STOP), "value")


def _pivot_sql(names, time=WHOLE_T, where=WHOLE):
    cells = ", ".join(f"round(avg(value) filter (metric = '{m}') + 1e-9, 6) as \"{m.replace('.', '_')}\"" for m in names)
    listed = ", ".join(f"'{m}'" for m in names)
    return f"""select product_type, "serialNumber", {time} as t, {cells}
    from panel_samples where {where} and metric in ({listed}) group by all"""


def _plain_names(df, names):
    for m in names:
        df = df.withColumnRenamed(m, m.replace(".", "_"))
    return _rounded(df, *[m.replace(".", "_") for m in names])


def _catalog(spark, samples):
    """The names a store lists when it is loaded."""
    path = scratch_path(spark, "names")
    samples.select("metric").distinct().write.parquet(path)
    return spark.read.parquet(path)


@query("q_panel_pivot", _pivot_sql(PANEL_METRICS, CUT_T, CUT))
def panel_pivot(spark, sf):
    rows = panel_samples(spark, sf)
    names = s.metric_names(_catalog(spark, rows), "")
    means = s.aggregate_window(rows, EVERY, KEYS, CUT_START, CUT_STOP)
    return _plain_names(s.pivot_series(means, names, TAGS), names)


@query(
    "q_panel_map",
    f"""select product_type, "serialNumber", t, string_agg(metric || '=' || cast(value as varchar), ',' order by metric) as means
    from (select product_type, "serialNumber", metric, {WHOLE_T} as t, cast(round(avg(value) + 1e-9, 2) as decimal(20, 2)) as value
      from panel_samples where {WHOLE} and metric like 'psoc.%' group by all) group by all""",
)
def panel_map(spark, sf):
    panel = replace(SAVED_PANELS["q13"], pivot=True)
    wide = panel_query(panel_samples(spark, sf), panel, EVERY, START, STOP)
    text = F.transform(
        F.map_entries("values"), lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"] + 1e-9, 2).cast("decimal(20, 2)").cast("string"))
    )
    return wide.select(*TAGS, "t", F.array_join(text, ",").alias("means"))


_MATCHES = {
    "q1": "metric like 'psoc.now.cpu.%'",
    "q2": "metric like 'psoc.now.temp.%'",
    "q3": "metric like 'psoc.now.vltg.%'",
    "q4": "metric like 'psoc.now.cur.%'",
    "q5": "metric = 'psoc.now.fan.rpm'",
    "q6": "metric = 'psoc.now.fan.duty'",
    "q7": "regexp_matches(metric, 'heater')",
    "q8": "metric like 'psoc.now.status.%'",
    "q9": r"regexp_matches(metric, 'kernel\.all\.cpu\.user|kernel\.all\.cpu\.sys|kernel\.all\.cpu\.idle')",
    "q10": r"regexp_matches(metric, 'mem\.util\.used|mem\.util\.free|mem\.util\.cached')",
    "q11": r"regexp_matches(metric, 'disk\.dev\.read_bytes|disk\.dev\.write_bytes')",
    "q12": r"regexp_matches(metric, 'network\.interface\.in\.bytes|network\.interface\.out\.bytes')",
    "q13": "metric like 'psoc.%'",
}
_PIVOTED = {
    "q1": ["psoc.now.cpu.cpu0", "psoc.now.cpu.cpu1"],
    "q2": ["psoc.now.temp.psoc", "psoc.now.temp.sensor1"],
    "q3": ["psoc.now.vltg.1v0", "psoc.now.vltg.3v3"],
    "q4": ["psoc.now.cur.3v3bus", "psoc.now.cur.poe"],
    "q7": ["psoc.now.heater.state", "psoc.now.status.heater"],
    "q8": ["psoc.now.status.fan", "psoc.now.status.heater"],
}


def _register_saved(key):
    panel, names = SAVED_PANELS[key], _PIVOTED.get(key)
    long_sql = f"""select product_type, "serialNumber", metric, {WHOLE_T} as t, round(avg(value) + 1e-9, 6) as value
    from panel_samples where {WHOLE} and {_MATCHES[key]} group by all"""

    @query(f"q_saved_{key}", _pivot_sql(names) if names else long_sql)
    def saved(spark, sf):
        samples = panel_samples(spark, sf)
        # The columns are the names that match, not those the SQL lists.
        matching = s.metric_names(_catalog(spark, samples), panel.pattern) if panel.pivot else None
        result = panel_query(samples, panel, EVERY, START, STOP, metrics=matching)
        return _plain_names(result, matching) if panel.pivot else _rounded(result, "value")

    if panel.legend:
        figures = {"mean": "round(avg(value) + 1e-9, 6) as mean", "max": "round(max(value) + 1e-9, 6) as max", "last": "round(arg_max(value, t) + 1e-9, 6) as last"}
        columns = ", ".join(figures[c] for c in panel.legend)

        @query(
            f"q_legend_{key}",
            f"""+ means as (select product_type, "serialNumber", metric, {WHOLE_T} as t, avg(value) as value
            from panel_samples where {WHOLE} and {_MATCHES[key]} group by all)
            select product_type, "serialNumber", metric, {columns} from means group by all""",
        )
        def legend(spark, sf):
            return _rounded(panel_legend(panel_samples(spark, sf), panel, EVERY, START, STOP), *panel.legend)


for _key in SAVED_PANELS:
    _register_saved(_key)


@query(
    "q_saved_one_device",
    f"""select product_type, "serialNumber", metric, {WHOLE_T} as t, round(avg(value) + 1e-9, 6) as value
    from panel_samples where {WHOLE} and product_type = 'SERVER3' and "serialNumber" = '15'
    and metric = 'psoc.now.fan.rpm' group by all""",
)
def saved_one_device(spark, sf):
    result = panel_query(
        panel_samples(spark, sf), SAVED_PANELS["q5"], EVERY, START, STOP, product_type="SERVER3", serial="15"
    )
    return _rounded(result, "value")


@query(
    "q_series_summary",
    """+ means as (select measurement, product_type, "serialNumber", field,
      timestamp '1970-01-01' + to_microseconds((epoch_us(ts) // 21600000000 + 1) * 21600000000) as t, avg(value) as value from telemetry group by all)
    select measurement, product_type, "serialNumber", field, round(avg(value) + 1e-9, 6) as mean, round(max(value) + 1e-9, 6) as max,
      round(arg_max(value, t) + 1e-9, 6) as last from means group by all""",
)
def series_summary(spark, sf):
    means = s.aggregate_window(telemetry(spark, sf), "6 hours", SERIES)
    return _rounded(s.series_summary(means, SERIES, ["mean", "max", "last"]), "mean", "max", "last")


@query(
    "q_series_count",
    """select measurement, product_type, "serialNumber", field, count(*) as n from telemetry group by all""",
)
def series_count(spark, sf):
    return s.series_count(telemetry(spark, sf))


def _latest(samples):
    return samples.agg(F.max("ts")).scalar()


@query(
    "q_relative_range",
    """select event_id, ts, metric, value from telemetry
    where ts >= (select max(ts) from telemetry) - interval 7 days""",
)
def relative_range(spark, sf):
    samples = telemetry(spark, sf)
    return s.since(samples, "7 days", _latest(samples)).select("event_id", "ts", "metric", "value")


@query(
    "q_tag_values",
    """select distinct product_type from telemetry where ts >= (select max(ts) from telemetry) - interval 30 days""",
)
def tag_values(spark, sf):
    samples = telemetry(spark, sf)
    return s.tag_values(samples, "product_type", "30 days", _latest(samples))


@query(
    "q_tag_values_dependent",
    """select distinct "serialNumber" from telemetry
    where ts >= (select max(ts) from telemetry) - interval 30 days and product_type = 'SERVER1'""",
)
def tag_values_dependent(spark, sf):
    samples = telemetry(spark, sf)
    return s.tag_values(samples, "serialNumber", "30 days", _latest(samples), F.col("product_type") == "SERVER1")


@query(
    "q_tag_any",
    """select product_type, "serialNumber", count(*) as n from telemetry where product_type = 'SERVER2' group by all""",
)
def tag_any(spark, sf):
    rows = s.tag_any(s.tag_any(telemetry(spark, sf), "product_type", "SERVER2"), "serialNumber", s.ANY)
    return s.series_count(rows, TAGS)


@query(
    "q_tag_exact",
    """select event_id, metric, value from telemetry where product_type = 'SERVER1' and "serialNumber" = '13'""",
)
def tag_exact(spark, sf):
    rows = s.tag_exact(s.tag_exact(telemetry(spark, sf), "product_type", "SERVER1"), "serialNumber", "13")
    return rows.select("event_id", "metric", "value")


@query(
    "q_tag_regex",
    """select product_type, count(*) as n from telemetry where regexp_matches(product_type, 'SERVER1') group by all""",
)
def tag_regex(spark, sf):
    return s.series_count(s.tag_regex(telemetry(spark, sf), "product_type", "SERVER1"), ["product_type"])


@query("q_field_equals", "select event_id, ts, value from telemetry where field = 'mem_util_free'")
def field_equals(spark, sf):
    rows = s.where_field(telemetry(spark, sf), "mem_util_free", DEFAULT_MEASUREMENT)
    return rows.select("event_id", "ts", "value")


@query(
    "q_field_in",
    """select event_id, field, value from telemetry where regexp_matches(field, '^(mem_util_free|disk_dev_read_sda)$')""",
)
def field_in(spark, sf):
    return s.where_fields(telemetry(spark, sf), ["mem_util_free", "disk_dev_read_sda"]).select("event_id", "field", "value")


@query(
    "q_metric_regex",
    r"select metric, count(*) as n from telemetry where regexp_matches(metric, 'read|^net.*eth[0-9]') group by all",
)
def metric_regex(spark, sf):
    return s.series_count(s.where_metric(telemetry(spark, sf), "read|^net.*eth[0-9]"), ["metric"])


@query(
    "q_generated_panel",
    f"""select product_type, "serialNumber", field, {WHOLE_T} as t, round(avg(value) + 1e-9, 6) as value from telemetry
    where {WHOLE} and field in ('kernel_all_load_1_minute', 'mem_util_free')
    and regexp_matches(product_type, 'SERVER1') group by all""",
)
def generated(spark, sf):
    fields = ["kernel_all_load_1_minute", "mem_util_free"]
    panel = generated_panel(telemetry(spark, sf), fields, EVERY, START, STOP, DEFAULT_MEASUREMENT, "SERVER1")
    return _rounded(panel, "value")


@query(
    "q_generated_panel_single",
    f"""select product_type, "serialNumber", field, {WHOLE_T} as t, round(avg(value) + 1e-9, 6) as value from telemetry
    where {WHOLE} and field = 'mem_util_free' group by all""",
)
def generated_single(spark, sf):
    panel = generated_panel(telemetry(spark, sf), ["mem_util_free"], EVERY, START, STOP, DEFAULT_MEASUREMENT)
    return _rounded(panel, "value")


@query(
    "q_adhoc_raw",
    """select event_id, ts, product_type, "serialNumber", metric, value from telemetry
    where ts >= (select max(ts) from telemetry) - interval 1 hour""",
)
def adhoc_raw(spark, sf):
    samples = telemetry(spark, sf)
    recent = s.since(samples, "1 hour", _latest(samples))
    return recent.select("event_id", "ts", *TAGS, "metric", "value")


@query(
    "q_adhoc_regex",
    f"""select product_type, "serialNumber", metric, {WHOLE_T} as t, round(avg(value) + 1e-9, 6) as value
    from panel_samples where {WHOLE} and regexp_matches(metric, 'cpu') group by all""",
)
def adhoc_regex(spark, sf):
    rows = s.where_metric(panel_samples(spark, sf), "cpu")
    return _rounded(s.aggregate_window(rows, EVERY, KEYS, START, STOP), "value")


@query(
    "q_adhoc_count",
    """select product_type, "serialNumber", metric, count(*) as n from panel_samples
    where ts >= (select max(ts) from panel_samples) - interval 30 days group by all""",
)
def adhoc_count(spark, sf):
    samples = panel_samples(spark, sf)
    return s.series_count(s.since(samples, "30 days", _latest(samples)), KEYS)


_LAST_IN_HOUR = """+ grid as (select "serialNumber", metric, date_trunc('hour', ts) as t,
      arg_max(value, ts) as value from telemetry group by all)"""


@query("q_resample", f"""{_LAST_IN_HOUR} select "serialNumber", metric, t, value from grid""")
def resample(spark, sf):
    return s.resample(telemetry(spark, sf), EVERY, ["serialNumber", "metric"], ["ts"])


@query(
    "q_resample_fill",
    f"""{_LAST_IN_HOUR}, spans as (select *, coalesce(lead(t) over (partition by "serialNumber", metric order by t)
      - interval 1 hour, t) as last_t from grid)
    select "serialNumber", metric, unnest(generate_series(t, last_t, interval 1 hour)) as t, value from spans""",
)
def resample_fill(spark, sf):
    return s.resample(
        telemetry(spark, sf), EVERY, ["serialNumber", "metric"], ["ts", "event_id"], fill=True, chunk_steps=48
    )


@query(
    "q_first_sample",
    """+ firsts as (select metric, min(ts) as ts from panel_samples group by metric order by metric limit 10)
    select metric, ts, min(value) as value from panel_samples join firsts using (metric, ts) group by all""",
)
def first_sample(spark, sf):
    return s.first_sample(panel_samples(spark, sf))


@query("q_tag_enrich", "select event_id, 'RACK7' as product_type, 'A-77' as \"serialNumber\", value from events")
def tag_enrich(spark, sf):
    return joins.with_tags(table(spark, sf, "events"), "RACK7", "A-77").select("event_id", *TAGS, "value")


@query(
    "q_device_join",
    """select event_id, coalesce(n_name, 'SERVER1') as product_type,
      coalesce(cast(c_custkey as varchar), '1234') as "serialNumber", metric
    from telemetry left join customer on c_custkey = user_id * 20 left join nation on n_nationkey = c_nationkey""",
)
def device_join(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    registry = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("device"),
        F.col("n_name").alias("product_type"),
        F.col("c_custkey").cast("string").alias("serialNumber"),
    )
    rows = telemetry(spark, sf).withColumn("device", F.col("user_id") * 20).drop(*TAGS)
    tagged = joins.with_device_tags(rows, registry, "SERVER1", "1234")
    return tagged.select("event_id", *TAGS, "metric")
