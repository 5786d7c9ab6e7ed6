"""Panel queries: range, tags, metric predicate, windowed mean, optional pivot, legend."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from pulsemill.operators import series as s
from pulsemill.schema import TAGS

LEGEND = ["mean", "max", "last"]


@dataclass(frozen=True)
class Panel:
    title: str
    pattern: str
    exact: bool = False
    pivot: bool = False
    tagged: bool = True
    legend: list[str] = field(default_factory=lambda: list(LEGEND))


# The saved panels and the metric names they ask for.
SAVED_PANELS = {
    "q1": Panel("CPU frequency", r"^psoc\.now\.cpu\.", pivot=True),
    "q2": Panel("Temperature", r"^psoc\.now\.temp\.", pivot=True),
    "q3": Panel("Voltage rails", r"^psoc\.now\.vltg\.", pivot=True),
    "q4": Panel("Current draw", r"^psoc\.now\.cur\.", pivot=True),
    "q5": Panel("Fan RPM", "psoc.now.fan.rpm", exact=True),
    "q6": Panel("Fan duty", "psoc.now.fan.duty", exact=True),
    "q7": Panel("Heater", "heater", pivot=True, legend=["last"]),
    "q8": Panel("Status flags", r"^psoc\.now\.status\.", pivot=True, legend=["last"]),
    "q9": Panel("CPU usage", r"kernel\.all\.cpu\.user|kernel\.all\.cpu\.sys|kernel\.all\.cpu\.idle", tagged=False, legend=[]),
    "q10": Panel("Memory", r"mem\.util\.used|mem\.util\.free|mem\.util\.cached", tagged=False, legend=[]),
    "q11": Panel("Disk I/O", r"disk\.dev\.read_bytes|disk\.dev\.write_bytes", tagged=False, legend=[]),
    "q12": Panel("Network", r"network\.interface\.in\.bytes|network\.interface\.out\.bytes", tagged=False, legend=[]),
    "q13": Panel("All sensors", r"^psoc\.", tagged=False, legend=["last", "mean"]),
}


def panel_rows(
    samples: DataFrame,
    panel: Panel,
    product_type: str = s.ANY,
    serial: str = s.ANY,
    measurement: str | None = None,
) -> DataFrame:
    """The samples a panel draws. Panels with tag filters take ANY for either tag."""
    rows = samples if measurement is None else samples.filter(samples["measurement"] == measurement)
    if panel.tagged:
        rows = s.tag_any(s.tag_any(rows, "product_type", product_type), "serialNumber", serial)
    return s.metric_equals(rows, panel.pattern) if panel.exact else s.where_metric(rows, panel.pattern)


def panel_query(
    samples: DataFrame,
    panel: Panel,
    every: str,
    start,
    stop,
    product_type: str = s.ANY,
    serial: str = s.ANY,
    measurement: str | None = None,
    metrics: list[str] | None = None,
) -> DataFrame:
    """Windowed means of a panel. One that pivots has a column for each name in ``metrics`` (see
    ``metric_names``), or without names all that match in a map; others are long."""
    rows = panel_rows(samples, panel, product_type, serial, measurement)
    if panel.pivot:
        if metrics is None:
            return s.pivot_map(rows, every, TAGS, start, stop)
        return s.pivot_window(rows, every, metrics, TAGS, start, stop)
    return s.aggregate_window(rows, every, [*TAGS, "metric"], start, stop)


def panel_legend(samples: DataFrame, panel: Panel, every: str, start, stop, **tags: str) -> DataFrame:
    """Legend figures per series, over the windowed means the panel shows."""
    means = s.aggregate_window(panel_rows(samples, panel, **tags), every, [*TAGS, "metric"], start, stop)
    return s.series_summary(means, [*TAGS, "metric"], panel.legend)


def generated_panel(
    samples: DataFrame,
    fields: list[str],
    every: str,
    start,
    stop,
    measurement: str,
    product_type: str = ".*",
    serial: str = ".*",
) -> DataFrame:
    """Panel of a metric chunk: tags by unanchored regex, one field or any of several."""
    rows = s.tag_regex(s.tag_regex(samples, "product_type", product_type), "serialNumber", serial)
    rows = rows.filter(rows["measurement"] == measurement)
    rows = s.where_field(rows, fields[0]) if len(fields) == 1 else s.where_fields(rows, fields)
    return s.aggregate_window(rows, every, [*TAGS, "field"], start, stop)
