"""Names the registered queries and keeps each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsemill.registered.views import EVENT_METRICS, PANEL_METRICS
from pulsemill.schema import DEFAULT_MEASUREMENT

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

_METRIC_CASE = "case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in EVENT_METRICS.items()) + " end"
_DEVICE = "'SERVER' || cast(user_id % 12 as varchar) as product_type, cast(user_id as varchar) as \"serialNumber\""

# Common table expressions that mirror the views.
_VIEWS = f"""
with telemetry as (
  select event_id, user_id, ts, '{DEFAULT_MEASUREMENT}' as measurement, {_DEVICE},
         {_METRIC_CASE} as metric, translate({_METRIC_CASE}, '.- ', '___') as field, value
  from events),
panel_samples as (
  select event_id, ts, {_DEVICE},
         ([{', '.join(f"'{m}'" for m in PANEL_METRICS)}])[cast(event_id % {len(PANEL_METRICS)} as int) + 1] as metric, value
  from events),
labels as (
  select metric || '-' || "serialNumber" as metric, ts,
         'run' || lpad(cast(event_id // 1000 as varchar), 8, '0') as archive, cast(event_id % 1000 as int) as pos
  from telemetry),
names as (select distinct metric from labels),
wide as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, l_linestatus,
         l_shipdate as ts, unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) as metric,
         unnest([l_quantity, l_extendedprice, l_discount, l_tax]) as value
  from lineitem),
wide_samples as (
  select 'line item' as measurement, l_returnflag as product_type, l_linestatus as "serialNumber", ts,
         metric as field, value
  from wide
  qualify row_number() over (partition by l_returnflag, l_linestatus, ts, metric
    order by l_orderkey desc, l_linenumber desc, l_partkey desc, l_suppkey desc, l_extendedprice desc, value desc) = 1),
report_lines as (
  select event_id, event_id // 1000 as report, (event_id // 1000) % 3 as variant, metric, value,
         date_trunc('second', ts) as ts, event_id % 10 as kind,
         event_id % 13 = 0 as bad_arity, event_id % 11 = 0 as bad_ts
  from telemetry),
report_values as (
  select event_id, report, ts, metric,
         case variant when 1 then 5 - list_position(['{"', '".join(EVENT_METRICS.values())}'], metric) + 1
           else list_position(['{"', '".join(EVENT_METRICS.values())}'], metric) end as pos,
         case when kind = 4 then 0.0 else value end as value
  from report_lines where not bad_arity and not bad_ts and kind not in (2, 3)
  union all
  select event_id, report, ts, 'mem-util-free', 6, value + 1
  from report_lines where not bad_arity and not bad_ts and variant = 2 and metric = 'mem.util.free' and event_id % 2 = 0),
report_samples as (
  select report, ts, metric, translate(metric, '.- ', '___') as field, value
  from report_values
  qualify row_number() over (partition by report, ts, translate(metric, '.- ', '___')
    order by event_id desc, pos desc) = 1)
"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. SQL that starts with ``+`` goes on with further table expressions."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            body = sql.strip()
            SQL[name] = _VIEWS.rstrip() + ("," + body[1:] if body.startswith("+") else "\n" + body)
        return function

    return register
