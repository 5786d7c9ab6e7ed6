"""Catalogue, category, membership and naming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsemill.operators import catalog as c
from pulsemill.operators import joins
from pulsemill.operators import reports as r
from pulsemill.registered.registry import query
from pulsemill.registered.views import labels, telemetry
from pulsemill.session import scratch_path
from pulsemill.sinks import tables
from pulsemill.sources.reports import read_label_csv, read_name_list

_CATEGORIES = """case when metric like 'proc.%' then 'proc' when metric like 'disk.%' then 'disk'
      when metric like 'mem.%' then 'mem' when metric like 'network.%' then 'network'
      when metric like 'kernel.%' then 'kernel' end"""
_ENABLED = {"disk": False, "swap": False, "mem": True}
_MIDDLE = "2024-01-03 00:00:00"


def _names(spark, sf):
    return labels(spark, sf).select("metric").distinct()


def _early(spark, sf):
    return labels(spark, sf).filter(F.col("ts") < F.lit(_MIDDLE).cast("timestamp_ntz"))


def _late(spark, sf):
    return labels(spark, sf).filter(F.col("ts") >= F.lit(_MIDDLE).cast("timestamp_ntz"))


@query(
    "q_category_filter",
    "select event_id, metric from telemetry where metric not like 'proc.%' and metric not like 'disk.%'",
)
def category_filter(spark, sf):
    return r.category_filter(telemetry(spark, sf), _ENABLED).select("event_id", "metric")


@query(
    "q_category_stats",
    f"""select {_CATEGORIES} as category, count(*) as removed from names
    where metric like 'proc.%' or metric like 'disk.%' group by all""",
)
def category_stats(spark, sf):
    return r.category_stats(_names(spark, sf), _ENABLED)


@query(
    "q_category_totals",
    """select count(*) as before, count(*) filter (metric like 'proc.%' or metric like 'disk.%') as removed,
      count(*) filter (metric not like 'proc.%' and metric not like 'disk.%') as after from names""",
)
def category_totals(spark, sf):
    return r.category_totals(_names(spark, sf), _ENABLED)


@query(
    "q_validated_semi",
    """+ labelled as (select event_id, metric || '-' || "serialNumber" as metric, value from telemetry)
    select event_id, metric, value from labelled
    where metric in (select metric from labelled group by metric having max(value) > 100)""",
)
def validated_semi(spark, sf):
    samples = telemetry(spark, sf).withColumn("metric", F.concat("metric", F.lit("-"), "serialNumber"))
    valid = samples.groupBy("metric").agg(F.max("value").alias("top")).filter("top > 100")
    path = scratch_path(spark, "validated")
    tables.write_validated(valid, path)
    return joins.keep_validated(samples, read_name_list(spark, path)).select("event_id", "metric", "value")


@query(
    "q_new_metrics_anti",
    f"""select distinct metric from labels where ts >= timestamp '{_MIDDLE}'
    and metric not in (select metric from labels where ts < timestamp '{_MIDDLE}')""",
)
def new_metrics_anti(spark, sf):
    path = scratch_path(spark, "catalog")
    tables.append_catalog(spark, c.seen_metrics(_early(spark, sf)), path)
    return joins.new_metrics(_late(spark, sf).select("metric").distinct(), tables.read_catalog(spark, path))


@query(
    "q_catalog_append",
    """+ firsts as (select metric, archive, pos, row_number() over (partition by metric order by archive, pos) as rn from labels)
    select metric, cast(1 as bigint) as first_seq, archive as first_archive, pos as first_pos from firsts where rn = 1""",
)
def catalog_append(spark, sf):
    path = scratch_path(spark, "catalog")
    for part in (_early(spark, sf), _late(spark, sf), _early(spark, sf)):
        tables.append_catalog(spark, c.seen_metrics(part), path)
    return tables.read_catalog(spark, path)


@query("q_union_labels", "select metric from names")
def union_labels(spark, sf):
    return c.union_labels(_early(spark, sf), _late(spark, sf))


@query("q_name_list", "select metric from names")
def name_list(spark, sf):
    path = scratch_path(spark, "names")
    tables.write_validated(labels(spark, sf), path)
    return read_name_list(spark, path)


@query("q_label_csv", "select metric from names")
def label_csv(spark, sf):
    path = scratch_path(spark, "labels")
    _names(spark, sf).withColumnRenamed("metric", "metric_name").write.option("header", "true").csv(path)
    return read_label_csv(spark, path)


_SPLIT = """split_part(metric, '.', 1) as top_level,
      split_part(metric, '.', 1) || '.' || split_part(metric, '.', 2) as subcategory"""


@query(
    "q_catalog_rollup",
    f"""+ leaves as (select {_SPLIT}, count(*) as n from names group by all)
    select top_level, subcategory, count(*) as n_sub, cast(sum(n) as bigint) as n from leaves
    group by rollup (top_level, subcategory)""",
)
def catalog_rollup(spark, sf):
    return c.catalog_rollup(_names(spark, sf))


@query(
    "q_group_titles",
    f"""+ leaves as (select {_SPLIT}, count(*) as n from names group by all),
    groups as (select top_level, count(*) as n_sub, cast(sum(n) as bigint) as n from leaves group by all)
    select top_level, n_sub, n, '[' || upper(top_level) || '] - ' || n_sub || ' subcategories, ' || n || ' metrics' as title
    from groups""",
)
def group_titles(spark, sf):
    return c.group_titles(_names(spark, sf))


@query(
    "q_panel_chunks",
    f"""+ firsts as (select metric, archive, pos, row_number() over (partition by metric order by archive, pos) as rn from labels),
    placed as (select {_SPLIT}, metric,
      row_number() over (partition by split_part(metric, '.', 1), split_part(metric, '.', 2) order by archive, pos, metric) as position,
      count(*) over (partition by split_part(metric, '.', 1), split_part(metric, '.', 2)) as total
      from firsts where rn = 1)
    select top_level, subcategory, metric, position, (position - 1) // 10 as chunk,
      case when total > 10 then '[' || subcategory || '] Metrics ' || ((position - 1) // 10 * 10 + 1) || '-'
        || least((position - 1) // 10 * 10 + 10, total) || ' of ' || total
        else '[' || subcategory || '] (' || total || ' metrics)' end as title,
      cast(case when ((position - 1) // 10) % 2 = 0 then 0 else 12 end as int) as x
    from placed""",
)
def panel_chunks(spark, sf):
    return c.panel_chunks(c.seen_metrics(labels(spark, sf)))


@query(
    "q_categorise",
    f"select metric, {_SPLIT} from names",
)
def categorise(spark, sf):
    return c.categorise(_names(spark, sf))


@query("q_catalog_sorted", f"select metric, {_SPLIT} from names order by 2, 3, 1")
def catalog_sorted(spark, sf):
    return c.sort_catalog(_names(spark, sf))


@query(
    "q_sample_names",
    "select metric, (select count(*) from names) - 10 as remaining from names order by metric limit 10",
)
def sample_names(spark, sf):
    return c.sample_names(_names(spark, sf))
